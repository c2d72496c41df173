"""Packing documents into training sequences by dynamic programming.

The documents of a partition follow each other as one stream of ids.  It may be
cut where a document or a sentence ends (and, in stretches without any such
place, elsewhere).  The cuts chosen have the smallest total of padding and of
penalties for cut documents; a sequence of a power of two ids needs no padding.
``best[j] = penalty[j] + min(best[i] + padding(j - i))``: for padding to the
full length the minimum over the last ``length`` ids slides along in a monotone
queue; the powers of two are looked up one by one.
"""

from __future__ import annotations

import os
import re
import string
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, compress, count, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallymark.llm import common

LENGTH = 2048
END_ID = 1
SENTENCE_PENALTY = 2.0
FORCED_PENALTY = 48.0

_CHUNK = 400_000  # ids in one run of the dynamic program; open ends are carried on
_WORDS = 450_000  # words whose ids a worker keeps
_TEXTS = 400_000  # characters of texts that are looked up together


_SENTENCE_ENDS = frozenset((".", "!", "?", "\n"))
# Texts are cut into words as numbers of 16 bits, looked up in these tables.  Behind a letter and before a blank,
# stops, commas and other marks are a token of their own (İ has a mark in lower case, | may end a control token).
_LATIN = ord("ɐ")  # below it case does not count, but for İ; beyond, that is left to the tokenizer
_BLANK, _LETTER, _MARK = 1, 2, 3
_KINDS = np.zeros(1 << 16, np.uint8)
_KINDS[ord(" ")] = _BLANK
_KINDS[[ord(c) for c in string.ascii_letters]] = _LETTER
_KINDS[[c for c in range(ord("ß"), _LATIN) if chr(c) not in "÷İ"]] = _LETTER
_KINDS[[ord(c) for c in string.punctuation if c != "|"]] = _MARK
_LOWER = np.arange(1 << 16, dtype=np.uint16)
_LOWER[:_LATIN] = [ord(chr(c).lower()[0]) for c in range(_LATIN)]

# Letters that the normalizer and the splitter leave as they are.
_LETTERS = re.compile("[a-zß-öø-ÿœ]+").fullmatch


def _words(texts: list[str]) -> tuple[list[str], list[int]]:
    """The words of all texts one after the other, and how many each text has (at least one, that may be empty)."""
    if not texts:
        return [], []
    own = [(text.replace("\n", " \n ") + " ").encode("utf-16-le") for text in texts]
    lengths = np.fromiter(map(len, own), np.int64, len(own)) // 2
    stops = np.cumsum(lengths)
    letters = np.frombuffer(b"".join(own), "<u2")
    as_is = np.fromiter(("<|" in text or "İ" in text for text in texts), bool, len(texts))
    as_is |= np.maximum.reduceat(letters, stops - lengths) >= _LATIN
    lower = _LOWER[letters]
    if as_is.any():
        np.copyto(lower, letters, where=np.repeat(as_is, lengths))
    kinds = _KINDS[lower]
    blanks = np.flatnonzero(kinds == _BLANK)
    mark = kinds == _MARK
    edges = np.flatnonzero(mark[1:] != mark[:-1]) + 1
    edges = edges[int(mark[0]) :]  # from here on runs of marks begin and end by turns
    first, behind = edges[::2], edges[1::2]
    marks = first[(kinds[first - 1] == _LETTER) & (kinds[behind] == _BLANK)]
    words = np.insert(lower, marks, ord(" ")).tobytes().decode("utf-16-le").split(" ")
    words.pop()  # behind the last blank
    until = np.searchsorted(blanks, stops) + np.searchsorted(marks, stops)
    return words, np.diff(until, prepend=0).tolist()


class WordIds:
    """Ids of texts, by way of the ids of their words between blanks and line ends.

    The tokenizer drops white space and never joins across it, so the ids of a
    text are those of its words one after the other.  Words of Latin letters, which
    its normalizer and splitter leave as they are, go to a copy without those two;
    all others to the tokenizer itself.  When a worker has learned ``_WORDS`` words
    it forgets those that it has needed least.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        known = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(known.values()) + 1, bool)
        self.last[[i for token, i in known.items() if token.endswith("</w>")]] = True
        self._begin()

    def _begin(self) -> None:
        """A word gets the next row of the tables below as soon as it is looked up."""
        self.index: defaultdict[str, int] = defaultdict(count(2).__next__, {"": 0, "\n": 1})
        self.known = 2  # rows whose ids are there
        self.flat = np.zeros(1 << 16, np.uint32)
        self.size = 0
        self.starts, self.lengths, self.used = (np.zeros(1 << 14, np.int64) for _ in range(3))
        self.ends = np.zeros(1 << 14, bool)
        self.ends[1] = True

    def _grown(self, name: str, needed: int) -> np.ndarray:
        old = getattr(self, name)
        if needed > len(old):
            old = np.concatenate([old, np.zeros(max(len(old), needed - len(old)), old.dtype)])
            setattr(self, name, old)
        return old

    def _put(self, rows: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self._grown("flat", self.size + len(ids))[self.size : self.size + len(ids)] = ids
        self.lengths[rows] = lengths
        self.starts[rows] = self.size + np.cumsum(lengths) - lengths
        self.size += len(ids)

    def _learn(self) -> None:
        """Find the ids of the words that were looked up for the first time."""
        words = list(islice(reversed(self.index), len(self.index) - self.known))[::-1]
        rows = np.arange(self.known, len(self.index))
        for name in ("starts", "lengths", "used", "ends"):
            self._grown(name, len(self.index))
        self.used[rows] = 0
        self.ends[rows] = [w[-1:] in _SENTENCE_ENDS for w in words]
        self.known = len(self.index)
        plain = np.fromiter(map(bool, map(_LETTERS, words)), bool, len(words))
        if plain.any():
            own = list(compress(words, plain))
            found = self.letters.encode_batch_fast([own], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found[0].ids, np.uint32)
            self._put(rows[plain], ids, np.diff(np.flatnonzero(self.last[ids]), prepend=-1))
        if not plain.all():
            others = list(compress(words, ~plain))
            found = [e.ids for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            self._put(rows[~plain], np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths)

    def _forget(self) -> None:
        """Keep at most half of the words: those needed most often since the last time."""
        used, half = self.used[: self.known], _WORDS // 2
        least = max(2, int(np.partition(used, -half)[-half]) + 1) if self.known > half else 2
        kept = np.flatnonzero(used[2:] >= least) + 2
        names = list(self.index)
        lengths = self.lengths[kept]
        first = np.cumsum(lengths) - lengths
        ids = self.flat[np.repeat(self.starts[kept] - first, lengths) + np.arange(int(lengths.sum()))]
        ends = self.ends[kept]
        self._begin()
        for row in kept.tolist():
            self.index[names[row]]  # noqa: B018
        self.known = len(self.index)
        for name in ("starts", "lengths", "used", "ends"):
            self._grown(name, self.known)
        self.ends[2 : self.known] = ends
        self._put(np.arange(2, self.known), ids, lengths)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``text``, and how many ids lie before each sentence end."""
        return self.of([text])[0]

    def of(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The same for several texts, whose unknown words are learned together."""
        if self.known > _WORDS:
            self._forget()
        words, sizes = _words(texts)
        rows = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if len(self.index) > self.known:
            self._learn()
        self.used[: self.known] += np.bincount(rows, minlength=self.known)
        lengths = self.lengths[rows]
        ends = np.cumsum(lengths)
        ids = self.flat[np.repeat(self.starts[rows] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]
        marks = self.ends[rows]
        out, word, at = [], 0, 0
        for size in sizes:
            own = ends[word : word + size]
            out.append((ids[at : own[-1]], own[marks[word : word + size]] - at))
            word, at = word + size, int(own[-1])
        return out


def _tokenizer(path: str) -> WordIds:
    """One per Python worker: tasks that follow each other share its words."""
    return common.kept(path, lambda: WordIds(path))


def cuts(places: np.ndarray, penalties: np.ndarray, length: int = LENGTH) -> list[int]:
    """The chosen ones among ``places`` (ascending, the last is always chosen).

    ``places`` counts the ids before a cut; neighbours are at most ``length``
    apart, the first at most ``length`` from 0.
    """
    end = int(places[-1])
    at = np.full(end + 1, -1, np.int64)
    at[0] = 0
    at[places] = np.arange(1, len(places) + 1)
    ends, begins = [], []
    power = 1
    while power <= length:
        inside = np.flatnonzero(places >= power)
        before = at[places[inside] - power]
        good = before >= 0
        ends.append(inside[good] + 1)
        begins.append(before[good])
        power *= 2
    numbers = np.concatenate(ends)
    earlier = np.concatenate(begins)[np.argsort(numbers, kind="stable")].tolist()  # a power of two before each place
    until = np.cumsum(np.bincount(numbers, minlength=len(places) + 1)).tolist()
    where = [0, *places.tolist()]
    costs = [0.0, *penalties.tolist()]
    best = [0.0] * len(where)
    back = [0] * len(where)
    # The queue, from head to tail: best + place, the place and its number.
    values, queue, number = [0.0] * len(where), [0] * len(where), [0] * len(where)
    head = tail = p = 0
    for j in range(1, len(where)):
        here = where[j]
        while queue[head] < here - length:
            head += 1
        i = number[head]
        least = values[head] + length - here
        stop = until[j]
        while p < stop:
            x = earlier[p]
            p += 1
            if best[x] < least:
                least, i = best[x], x
        best[j] = value = least + costs[j]
        back[j] = i
        value += here
        while tail >= head and values[tail] >= value:
            tail -= 1
        tail += 1
        values[tail], queue[tail], number[tail] = value, here, j
    chosen, j = [], len(where) - 1
    while j:
        chosen.append(where[j])
        j = back[j]
    return chosen[::-1]


class _Stream:
    """The open end of a partition's stream and the documents in it."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.ids: list[np.ndarray] = []
        self.size = 0
        self.places: list[np.ndarray] = []
        self.penalties: list[np.ndarray] = []
        # (doc_id, first id here, ids of the document before that, all its ids)
        self.documents: list[tuple[int | None, int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray, sentences: np.ndarray) -> None:
        self.documents.append((doc_id, self.size, 0, len(ids)))
        inner = sentences[(sentences > 0) & (sentences < len(ids))]  # ascending, repeats go in solve
        self.places.append(np.append(inner, len(ids)) + self.size)
        self.penalties.append(np.append(np.full(len(inner), SENTENCE_PENALTY), 0.0))
        self.ids.append(ids)
        self.size += len(ids)

    def solve(self, final: bool) -> tuple[np.ndarray, list[int]]:
        places, penalties = np.concatenate(self.places), np.concatenate(self.penalties)
        keep = np.append(places[1:] > places[:-1], True)
        places, penalties = places[keep], penalties[keep]
        gaps = np.diff(places, prepend=0)
        wide = np.flatnonzero(gaps > self.length)
        more = [np.arange(places[w] - gaps[w] + self.length, places[w], self.length) for w in wide]
        if final:  # any place will do in the last sequences, so that they need little padding
            more.append(np.arange(max(1, self.size - 2 * self.length), self.size))
        if more:
            forced = np.setdiff1d(np.concatenate(more), places)
            order = np.argsort(np.concatenate([places, forced]), kind="stable")
            places = np.concatenate([places, forced])[order]
            penalties = np.concatenate([penalties, np.full(len(forced), FORCED_PENALTY)])[order]
        chosen = cuts(places, penalties, self.length)
        return np.concatenate(self.ids), chosen if final else chosen[:-1]

    def carry(self, ids: np.ndarray, done: int) -> None:
        """Go on with what lies behind the first ``done`` ids."""
        places, penalties = np.concatenate(self.places), np.concatenate(self.penalties)
        open_ = places > done
        self.places, self.penalties = [places[open_] - done], [penalties[open_]]
        self.ids, self.size = [ids[done:]], self.size - done
        still = []
        for doc_id, first, before, total in self.documents:
            if first + total - before > done:
                gone = max(0, done - first)
                still.append((doc_id, max(0, first - done), before + gone, total))
        self.documents = still


def _pieces(stream: _Stream, ids: np.ndarray, chosen: list[int], number: int) -> Iterator[tuple]:
    """(doc_id, start, length, ids, doc_tokens, sequence, offset) up to the last cut."""
    documents, d, begin = stream.documents, 0, 0
    for end in chosen:
        while d < len(documents):
            doc_id, first, before, total = documents[d]
            last = first + total - before
            a, b = max(first, begin), min(last, end)
            if a < b:
                yield doc_id, before + a - first, b - a, ids[a:b].astype("<u4").tobytes(), total, number, a - begin
            if last > end:
                break
            d += 1
        number, begin = number + 1, end


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
_COLUMNS = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _together(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[str]]]:
    """Documents in lots of about ``_TEXTS`` characters."""
    doc_ids, texts, size = [], [], 0
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
        doc_ids.append(doc_id)
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= _TEXTS:
            yield doc_ids, texts
            doc_ids, texts, size = [], [], 0
    if texts:
        yield doc_ids, texts


def _packer(path: str, length: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, stream = _tokenizer(path), _Stream(length)
        number = TaskContext.get().partitionId() << 33

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number
            ids, chosen = stream.solve(final)
            rows = list(_pieces(stream, ids, chosen, number))
            number += len(chosen)
            stream.carry(ids, chosen[-1] if chosen else 0)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

        for batch in batches:
            for doc_ids, texts in _together(batch):
                for doc_id, (ids, sentences) in zip(doc_ids, words.of(texts)):
                    stream.add(doc_id, np.append(ids, np.uint32(end_id)), sentences)
                    if stream.size >= _CHUNK:
                        yield from flush(False)
        if stream.size:
            yield from flush(True)

    return run


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents, each lying in one sequence of at most ``length`` ids.

    Columns: doc_id, start (ids of the document before the piece), length, ids
    (little-endian unsigned 32-bit numbers), doc_tokens (ids of the document, end
    id included), sequence_id, offset (of the piece in its sequence).

    A document's ids are its text's, without special tokens, and ``end_id``; NULL
    and empty texts have the end id alone.  Every row is a document of its own,
    repeated ids included.  Sequences do not reach across partitions of ``docs``;
    their numbers are unique and the same on every run over the same partitions.
    """
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_packer(tokenizer_path, length, end_id), _COLUMNS)
