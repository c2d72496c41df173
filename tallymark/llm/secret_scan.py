"""Secrets in texts, by lexing assignments in source code and configuration.

Lines that may assign are cut into tokens (strings, names, operators), which give
pairs of a target name and what is assigned to it: a literal, a constant's name,
a sum of both, or the literals of a call.  Constants are followed to their
literals.  A literal is scored by the words of the target's name and by how
random it looks.  Three plain patterns, whatever stands around them, are reported
besides.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The plain patterns, in the order in which kinds are listed.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "literal")

MIN_SCORE = 0.4
# So many definitions are followed from one target at most.
MAX_STEPS = 64
# Workers keep the scores of names up to this length; longer ones are scored each time.
SHORT_NAME = 400

# Words of a name that speak for a secret, and words that speak against one.
_TELLING = {
    "password": 0.95, "passwd": 0.95, "passphrase": 0.95, "pwd": 0.9, "pass": 0.8, "pw": 0.6, "secret": 0.95, "secrets": 0.9,
    "token": 0.85, "apikey": 0.9, "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "auth": 0.5, "authorization": 0.7,
    "authentication": 0.6, "key": 0.45, "private": 0.45, "api": 0.25, "access": 0.3, "signing": 0.4, "signature": 0.4,
    "encryption": 0.45, "hmac": 0.5, "salt": 0.5, "seed": 0.3, "pin": 0.4, "otp": 0.5, "jwt": 0.7, "oauth": 0.5,
    "session": 0.35, "cookie": 0.35, "dsn": 0.4, "webhook": 0.4, "master": 0.2, "root": 0.2, "client": 0.1, "admin": 0.2,
}
_HARMLESS = frozenset(
    "name names id ids file files filename path dir url uri host length len size count type kind hint label field column "
    "prompt placeholder regex pattern policy min max limit expiry expires expiration ttl timeout public title text "
    "message error format prefix suffix header version enabled required reset help description example".split()
)
_PART = re.compile("[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_PLACEHOLDER = re.compile(
    r"(?i)change.?me|example|placeholder|dummy|redacted|your[_\- ]|insert|replace|todo|x{4,}|\*{3,}|\.{3,}|^<.*>$|^\$|\{\{|%\(|%s|"
    r"^(none|null|nil|true|false|undefined|string|str|bytes|password|passwd|secret|token|default|empty)$"
)

_TOKEN = re.compile(
    r"""(?P<long>(?P<q3>\"{3}|'{3})(?:\\[\s\S]|(?!(?P=q3))[^\\])*(?P=q3))"""
    r"""|(?P<text>(?<!\w)(?P<q>["'`])(?:\\.|(?!(?P=q))[^\\\n])*(?P=q))"""
    r"""|(?P<name>[^\W\d][\w$]*(?:[.-](?=[^\W\d])[\w$]+)*)"""
    r"""|(?P<op>:=|=>|==|!=|<=|>=|\+=|\?=|[=:+,()\[\]{};])"""
    r"""|(?P<other>[^\s"'`=:+,()\[\]{};]+)"""
)
_SETS = frozenset(("=", ":=", "=>", ":", "?=", "+="))
_BARE = re.compile(r"""[ \t]*([^\s"'`,;(){}\[\]]+)""")
_FETCHES = re.compile(r"(?i)env|get|fetch|lookup|param|option")


@dataclass
class _Pair:
    """A target and what it is given: literals (start, end) and names of constants."""

    target: str
    at: int
    literals: list[tuple[int, int]] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    bare: bool = False  # not quoted: a name or a value


def _lines(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the lines with an assignment sign; an open long string goes to its end."""
    done = 0
    for found in re.finditer("[:=]", text):
        at = found.start()
        if at < done:
            continue
        start = max(text.rfind("\n", 0, at) + 1, done)
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        for mark in ('"""', "'''"):
            if text.count(mark, start, end) % 2 and (close := text.find(mark, end)) >= 0:
                end = close + 3
        yield start, end
        done = end


def _content(token: re.Match) -> tuple[int, int]:
    cut = 3 if token.lastgroup == "long" or token["long"] else 1
    return token.start() + cut, token.end() - cut


def _kind(token: re.Match) -> str:
    return next(k for k in ("long", "text", "name", "op", "other") if token[k] is not None)


def _target(tokens: list[re.Match], kinds: list[str], i: int) -> str | None:
    """The name that the sign at ``i`` gives a value to."""
    j = i - 1
    if j >= 0 and tokens[j][0] == "]" and j >= 2:  # settings["name"] =
        j -= 1
    if j < 0:
        return None
    if kinds[j] in ("text", "long"):
        a, b = _content(tokens[j])
        return tokens[j].string[a:b]
    if kinds[j] != "name":
        return None
    if tokens[i][0] == "=" and j >= 2 and tokens[j - 1][0] == ":" and kinds[j - 2] == "name":
        return tokens[j - 2][0]  # name: type = value
    return tokens[j][0]


def _closes(tokens: list[re.Match]) -> dict[int, int]:
    """Where every bracket that is closed on its line is closed."""
    found, opened = {}, []
    for i, token in enumerate(tokens):
        if token[0] == "(":
            opened.append(i)
        elif token[0] == ")" and opened:
            found[opened.pop()] = i
    return found


def _value(
    pair: _Pair, text: str, tokens: list[re.Match], kinds: list[str], closes: dict[int, int], i: int, end: int
) -> None:
    """Take what stands behind the sign at ``i``: parts joined by ``+`` or side by side, or a call."""
    j, n = i + 1, len(tokens)
    while j < n:
        if kinds[j] in ("text", "long"):
            pair.literals.append(_content(tokens[j]))
            j += 1
        elif kinds[j] == "name" and closes.get(j + 1) and tokens[j + 1].start() == tokens[j].end():
            first, k = len(pair.literals), j + 2
            while k < closes[j + 1]:  # the call's own strings; a look-up's first one is a name
                if kinds[k] in ("text", "long"):
                    pair.literals.append(_content(tokens[k]))
                k = closes.get(k, k) + 1
            if _FETCHES.search(tokens[j][0]) and len(pair.literals) > first:
                del pair.literals[first]
            j = closes[j + 1] + 1
        elif kinds[j] == "name" and (j > i + 1 or _quoted_or_constant(text, tokens[j], end)):
            pair.names.append(tokens[j][0])
            j += 1
        elif j == i + 1:
            found = _BARE.match(text, tokens[i].end(), end)
            if found:
                pair.literals.append(found.span(1))
                pair.bare = True
                if kinds[j] == "name":
                    pair.names.append(found[1])
            return
        else:
            return
        if j < n and tokens[j][0] == "+":
            j += 1
        elif not (j < n and kinds[j] in ("text", "long") and kinds[j - 1] in ("text", "long")):
            return


def _quoted_or_constant(text: str, token: re.Match, end: int) -> bool:
    """Whether a sum goes on behind the name, which then is no bare value."""
    return text[token.end() : min(end, token.end() + 4)].lstrip(" \t").startswith("+")


def pairs(text: str) -> list[_Pair]:
    """All (target, value) pairs of the text, in its order."""
    found = []
    for start, end in _lines(text):
        tokens = list(_TOKEN.finditer(text, start, end))
        kinds = [_kind(t) for t in tokens]
        closes = _closes(tokens)
        for i, token in enumerate(tokens):
            if kinds[i] == "op" and token[0] in _SETS and (name := _target(tokens, kinds, i)):
                pair = _Pair(name, token.start())
                _value(pair, text, tokens, kinds, closes, i, end)
                if pair.literals or pair.names:
                    found.append(pair)
    return found


def _constants(found: list[_Pair]) -> dict[str, list[_Pair]]:
    known: dict[str, list[_Pair]] = {}
    for pair in found:
        known.setdefault(pair.target, []).append(pair)
    return known


def _followed(pair: _Pair, known: dict[str, list[_Pair]]) -> Iterator[tuple[tuple[int, int], bool, str]]:
    """(literal, bare, name it came by) of a pair, constants followed wherever they lead."""
    todo, seen = [(pair, "")], set()
    while todo:
        one, via = todo.pop()
        if len(seen) > MAX_STEPS:
            return
        own = [n for n in one.names if n in known or n.rpartition(".")[2] in known]
        for name in own:
            given = known.get(name) or known[name.rpartition(".")[2]]
            last = given[max(0, bisect_left(given, one.at, key=lambda g: g.at) - 1)]
            if last is not pair and last.at not in seen:
                seen.add(last.at)
                todo.append((last, name))
        if not (one.bare and own):  # a bare name that is a constant is no value
            for literal in one.literals:
                yield literal, one.bare, via


# Scores -----------------------------------------------------------------------


def name_score(name: str) -> float:
    """How much a target's whole name speaks for a secret, 0 to 1."""
    return _short_name_score(name) if len(name) <= SHORT_NAME else _name_score(name)


def _name_score(name: str) -> float:
    unlikely, factor = 1.0, 1.0
    for part in _PART.finditer(name):
        word = part[0].lower()
        unlikely *= 1 - _TELLING.get(word, 0.0)
        factor *= 0.2 if word in _HARMLESS else 1.0
    return (1 - unlikely) * factor


_short_name_score = lru_cache(20_000)(_name_score)


def literal_score(literal: str, bare: bool = False) -> float:
    """How much a literal looks like a secret, 0 to 1: bits of its letters, 32 are enough."""
    if len(literal) < 6 or _PLACEHOLDER.search(literal) or any(c.isspace() for c in literal):
        return 0.0
    kinds = sum(any(test(c) for c in literal) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    if bare and (kinds < 2 or not any(c.isdigit() for c in literal)):
        return 0.0
    counts = Counter(literal)
    bits = sum(n * math.log2(len(literal) / n) for n in counts.values())
    return min(1.0, bits / 32) * (1.0 if kinds > 1 else 0.6)


def spans(text: str, min_score: float = MIN_SCORE) -> list[tuple[str, int, int, str, str, float]]:
    """(kind, start, end, name, via, score) of all secrets, by start and kind."""
    plain = [("assign", *m.span(), m[1], "", 1.0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    plain += [("access", *m.span(), "", "", 1.0) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    plain += [("hex", *m.span(), "", "", 1.0) for m in _HEX.finditer(text)]
    found = pairs(text)
    known = _constants(found)
    best: dict[tuple[int, int], tuple[float, str, str]] = {}
    for pair in found:
        sensitive = name_score(pair.target)
        if sensitive < min_score:
            continue
        for (a, b), bare, via in _followed(pair, known):
            score = sensitive * literal_score(text[a:b], bare)
            if score >= min_score and score > best.get((a, b), (0.0,))[0]:
                best[a, b] = score, pair.target, via
    covered = sorted(x[1:3] for x in plain)
    own, reach, k = [], -1, 0
    for (a, b), (score, name, via) in sorted(best.items()):
        while k < len(covered) and covered[k][0] <= a:
            reach = max(reach, covered[k][1])
            k += 1
        if b > reach:  # else a plain pattern has it
            own.append(("literal", a, b, name, via, score))
    return sorted(plain + own, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


_FOUND = "doc_id long, secrets array<struct<kind: string, start: long, end: long, name: string, via: string, score: double>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()),
                   ("via", pa.string()), ("score", pa.float64())])
_KEYS = [f.name for f in _SPAN]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[dict(zip(_KEYS, x)) for x in spans(text.as_py() or "")] for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(found, pa.list_(_SPAN))], names=["doc_id", "secrets"]
        )


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, secrets): the secrets of every row's whole text, by start and kind.

    A secret has a kind (``assign``, ``access``, ``hex``: the plain patterns;
    ``literal``: found by its assignment), start and end in code points, the name
    it is given to, the constant it came by, and a score.  Literals inside a plain
    span are not listed again.  A constant that is given values more than once has
    the last one before its use, else its first; from one target MAX_STEPS
    definitions are followed.

    NULL and empty texts have none; a NULL doc_id stays.  Every row is a document
    of its own, repeated ones, too.  Texts of any length are read whole.  Only
    doc_id and text are read, whatever other columns are called.
    """
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return texts.mapInArrow(_scan, _FOUND)


def as_text(secrets: Column) -> Column:
    """``kind:start:end`` of every secret, comma-joined."""
    return F.array_join(
        F.transform(secrets, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def of_kind(secrets: Column, kind: str) -> Column:
    return F.size(F.filter(secrets, lambda x: x["kind"] == kind)).cast("long")
