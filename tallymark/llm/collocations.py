"""Phrase collocations of every language, mined with stripes.

A stripe is what one prefix of up to two words knows: how often it occurs and an
associative counter of the words that follow it.  Every task keeps the stripes of
its texts as sorted arrays of numbers.  They leave it element by element, dealt
out by a hash of prefix and next word together, so the elements of a very common
prefix go to all reducers, and merging them is one grouped sum.  An element
(prefix, next word) is the total of the longer prefix at the same time: one
structure holds extensions, prefix totals and what a phrase is part of.  Only
elements of ``min_count`` and more are kept; all a score needs is among them,
because no part of a phrase is rarer than the phrase.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import reliable_copy

MIN_COUNT = 10
PER_LANG = 2000
UNKNOWN = "und"

_FLUSH = 1_200_000  # words whose stripes a task holds
_TEXTS = 250_000  # elements that are spelled out at once
_SLICE = 2_000_000  # bytes of a text that are taken apart at once
_BUCKETS = 4  # per reduce task: they even out what a task gets
_BREAK = 1  # number of the mark between pieces; 0 is nothing between two blanks

# A-Z to a-z, marks that end a piece to a line end, tabs to blanks.
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" "
)


def _slices(text: bytes) -> Iterator[bytes]:
    """The text in parts, each beginning with a blank or a line end but the first."""
    at = 0
    while at < len(text):
        end = at + _SLICE
        if end < len(text):
            ends = [x for x in (text.find(b" ", end), text.find(b"\n", end)) if x >= 0]
            end = min(ends, default=len(text))
        yield text[at:end]
        at = end


class Stripes:
    """Stripes of the texts of a task, up to about ``_FLUSH`` words at once."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self._begin([])

    def _begin(self, carried: list[tuple[str, list[bytes]]]) -> None:
        number = count(2)
        self.index: dict[str, defaultdict[bytes, int]] = {}
        self.number = number.__next__
        self.ids: list[np.ndarray] = []
        self.size = 0
        for lang, words in carried:
            self._add(lang, words)

    def _add(self, lang: str, words: list[bytes]) -> None:
        index = self.index.get(lang)
        if index is None:
            # 0 and 1 mean the same in every language; the other numbers are given once.
            index = self.index[lang] = defaultdict(self.number, {b"": 0, b"\n": _BREAK})
        ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        self.ids.append(ids[ids > 0])
        self.size += len(self.ids[-1])

    def add(self, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        for part in _slices(text.translate(_FOLD)):
            self._add(lang, part.replace(b"\n", b" \n ").split(b" "))
            if self.size >= _FLUSH:
                yield from self.flush(lang)
        self._add(lang, [b"\n"])

    def flush(self, lang: str | None = None) -> Iterator[pa.RecordBatch]:
        """The elements so far; the last two words wait where a text of ``lang`` goes on."""
        ids = np.concatenate([*self.ids, np.full(2, _BREAK, np.int64)]) if self.ids else np.empty(0, np.int64)
        n = len(ids) - 2
        names: list[bytes] = [b""] * (2 + sum(len(x) - 2 for x in self.index.values()))
        langs = np.zeros(len(names), np.int32)
        for k, index in enumerate(self.index.values()):
            for word, i in index.items():
                names[i] = word
            langs[np.fromiter(index.values(), np.int64, len(index))] = k
        kept: list[tuple[str, list[bytes]]] = []
        if lang is not None and n > 2:
            own = list(self.index)
            # After a text of blanks they may be of the text before, in another language.
            kept = [(lang, [b"\n"]) if i == _BREAK else (own[langs[i]], [names[i]]) for i in ids[n - 2 : n].tolist()]
            n -= 2
        if n > 0:
            yield from self._elements(ids, n, names, langs)
        self._begin(kept)

    def _elements(self, ids: np.ndarray, n: int, names: list[bytes], langs: np.ndarray) -> Iterator[pa.RecordBatch]:
        own = list(self.index)
        totals = np.bincount(langs[ids[:n][ids[:n] != _BREAK]], minlength=len(own)).tolist()
        yield _rows([0] * len(own), own, pa.array([""] * len(own)), pa.array([[x] for x in totals], pa.list_(pa.int64())))
        words, times = _merged(ids, n, len(names))
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), np.uint64, len(names))
        mixed = hashes[words[0]]
        for w in words[1:]:
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0x9E3779B97F4A7C15)
            mixed += hashes[w]
        mixed ^= mixed >> np.uint64(32)
        group = (mixed % np.uint64(self.buckets)).astype(np.int32) + langs[words[0]] * np.int32(self.buckets)
        del mixed, hashes
        order = np.argsort(group, kind="stable").astype(np.int32)  # within a group still by prefix
        words, times, group = [w[order] for w in words], times[order], group[order]
        del order
        vocabulary = pa.array(names, pa.binary()).cast(pa.string())
        starts = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
        first = 0
        while first < len(starts) - 1:  # texts are made for some groups at a time
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + _TEXTS, "right")) - 1)
            part = slice(starts[first], starts[last])
            offsets = pa.array(starts[first : last + 1] - starts[first], pa.int32())
            columns = [vocabulary.take(pa.array(w[part])) for w in words]
            phrases = pc.utf8_rtrim(pc.binary_join_element_wise(*columns, " "), " ")
            groups = group[starts[first:last]]
            yield _rows(
                groups % self.buckets,
                [own[k] for k in (groups // self.buckets).tolist()],
                pc.binary_join(pa.ListArray.from_arrays(offsets, phrases), "\n"),
                pa.ListArray.from_arrays(offsets, pa.array(times[part], pa.int64())),
            )
            first = last


def _merged(ids: np.ndarray, n: int, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The elements of all stripes, by prefix: numbers of up to three words (0: none) and counts."""
    first = np.flatnonzero(ids[:n] != _BREAK)
    singles, times1 = np.unique(ids[first], return_counts=True)
    at = first[ids[first + 1] != _BREAK]
    pairs, of_pair, times2 = np.unique(ids[at] * size + ids[at + 1], return_inverse=True, return_counts=True)
    longer = np.flatnonzero(ids[at + 2] != _BREAK)
    triples, times3 = np.unique(of_pair[longer] * size + ids[at[longer] + 2], return_counts=True)
    inner = pairs[triples // size]
    none = np.zeros(len(singles) + len(pairs), np.int32)
    words = [
        np.concatenate([singles, pairs // size, inner // size], dtype=np.int32, casting="unsafe"),
        np.concatenate([none[: len(singles)], pairs % size, inner % size], dtype=np.int32, casting="unsafe"),
        np.concatenate([none, triples % size], dtype=np.int32, casting="unsafe"),
    ]
    return words, np.concatenate([times1, times2, times3], dtype=np.int32, casting="unsafe")


def _rows(bucket, lang, phrases: pa.Array, times: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int64()), pa.array(lang, pa.string()), phrases, times],
        names=["bucket", "lang", "phrases", "times"],
    )


_COLUMNS = "bucket long, lang string, phrases string, times array<long>"


def _striper(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes = Stripes(buckets)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                yield from stripes.add(lang, text.as_py())
        yield from stripes.flush()

    return run


def counts(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, n): phrases of one to three words with ``min_count`` occurrences or more.

    The empty phrase counts all words of the language.
    """
    texts = docs.select(
        F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    tasks = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    striped = texts.mapInArrow(_striper(_BUCKETS * tasks), _COLUMNS).repartition(tasks, "bucket")
    elements = striped.select(
        "bucket", "lang", F.posexplode(F.split("phrases", "\n")).alias("i", "phrase"), "times"
    ).select("bucket", "lang", "phrase", F.get("times", F.col("i")).alias("n"))
    # Elements of one phrase share their bucket, so this sum needs no second shuffle.
    merged = elements.groupBy("bucket", "lang", "phrase").agg(F.sum("n").alias("n"))
    return merged.where((F.col("n") >= min_count) | (F.col("phrase") == "")).select("lang", "phrase", "n")


_EXACT = "decimal(38,0)"


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def score(a: str, l: str, r: str) -> Column:
    """``1000000 * a * a / (l * r)``, rounded down, by whole numbers of 38 digits."""
    above = (F.lit(1_000_000).cast("decimal(7,0)") * (_wide(a) * _wide(a)).cast(_EXACT)).cast(_EXACT)
    return F.call_function("div", above, (_wide(l) * _wide(r)).cast(_EXACT))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, subsumed: int = 50) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every phrase of two or three words worth having.

    ``a`` is how often the phrase occurs within pieces of text between marks,
    overlaps included, at least ``min_count``.  Of its cuts into two parts,
    occurring ``l`` and ``r`` times, the one with the lowest score
    ``1000000 * a * a / (l * r)``, rounded down, counts; of equal ones the
    earliest.  A phrase inside a longer one that has ``subsumed`` per cent of its
    occurrences is left out.  ``n`` counts all words of the language.

    NULL lang is ``und``; NULL and empty texts have no words.  Every row counts,
    repeated ones, too.  Texts of any length are read whole.  Only lang and text
    are read, whatever other columns are called.
    """
    found = reliable_copy(counts(docs, min_count))
    words = F.size(F.split("phrase", " "))
    candidates = found.where(F.col("phrase").contains(" ")).withColumnRenamed("n", "a")
    part = lambda n: F.substring_index("phrase", " ", n)
    cuts = F.when(
        words == 2, F.array(F.struct(F.lit(1).alias("k"), part(1).alias("first"), part(-1).alias("rest")))
    ).otherwise(
        F.array(
            F.struct(F.lit(1).alias("k"), part(1).alias("first"), part(-2).alias("rest")),
            F.struct(F.lit(2).alias("k"), part(2).alias("first"), part(-1).alias("rest")),
        )
    )
    cut = candidates.select("lang", "phrase", "a", F.inline(cuts))
    left = found.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = found.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score("a", "l", "r"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    # What a phrase of two words is part of: the largest element on either side of it.
    inside = candidates.where(words == 3).select(
        "lang", F.col("a").alias("longer"), F.explode(F.array(part(2), part(-2))).alias("phrase")
    ).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(100) * _wide("longer") < F.lit(subsumed) * _wide("a"))
    )
    totals = found.where(F.col("phrase") == "").select("lang", "n")
    return kept.join(F.broadcast(totals) if _few(totals) else totals, "lang").select(
        "lang", "phrase", "a", "best.l", "best.r", "n", "best.score"
    )


def _few(totals: DataFrame, most: int = 10_000) -> bool:
    return totals.count() <= most


def top(found: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """The first ``per_lang`` phrases of each language, with their ``rank``.

    By score and occurrences, both descending, then by the phrase's bytes.  Parts
    of a language are cut to that number before they meet.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    partly = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    ranked = partly.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    few = ranked.where(F.col("rank") <= per_lang).drop("rank", "part")
    number = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return few.withColumn("rank", number).where(F.col("rank") <= per_lang)
