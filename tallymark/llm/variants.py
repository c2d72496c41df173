"""Spelling variants of the words of a corpus, found in a frequency-vector trie.

Letters are put in groups; a word's vector says how many letters it has of each.
Level by level the trie branches on the count of one group.  Replacing a letter
adds one to a count and takes one from another at most, adding or leaving out a
letter changes one count by one: a search goes down with a surplus and a deficit
of one to spend, and the words at the leaves it reaches are verified.

The first levels are dealt out: every word goes to the node of its own counts and
to those within the budget, so a subtree and its searches meet in one task.  Large
subtrees are cut into blocks of ``BLOCK`` words; searches go past a block in
batches, which are the only rows a task holds beside it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.session import reliable_copy

MIN_LENGTH = 7
MIN_COUNT = 2
FACTOR = 10
DAMAGE = 31

# Groups in the order of the levels; whatever is in none of them makes one more.
GROUPS = ("e", "t", "n", "a", "i", "o", "r", "s", "h", "l", "d", "u", "cm", "gb", "fwyvp")
DEALT = 4
BLOCK = 40_000
_SEARCHES = 40_000  # searches that go down together
_LEAF = 12  # with so few words a node is not cut further
_HELD = 400_000  # words that a task counts before it hands them on
_PAIRS = 200_000  # candidates verified at once
_WIDE = 64  # longer words are verified one by one

_RUN = re.compile(f"[a-zÀ-ÿ]{{{MIN_LENGTH},}}")


# Words ------------------------------------------------------------------------


def damaged(doc_id: int | None, run: str) -> str:
    """The run, without one code point where a hash of document and run says so."""
    h = zlib.crc32(run.encode(), zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode())))
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
        )

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            lower = text.as_py().lower().decode()  # of bytes: A-Z only
            for run, times in Counter(_RUN.findall(lower)).items():
                held[damaged(doc_id, run)] += times
            if len(held) > _HELD:
                yield rows()
                held.clear()
    yield rows()


def words(docs: DataFrame) -> DataFrame:
    """(word, n): words of MIN_LENGTH code points or more that occur MIN_COUNT times."""
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    counted = texts.mapInArrow(_count_words, "word string, n long")
    totals = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return totals.where((F.col("n") >= MIN_COUNT) & (F.length("word") >= MIN_LENGTH))


# The trie ---------------------------------------------------------------------

_GROUP_OF = np.full(256, len(GROUPS), np.int64)
for _i, _letters in enumerate(GROUPS):
    _GROUP_OF[[ord(x) for x in _letters]] = _i


class _Words:
    """Words with their counts of the groups that are not dealt out."""

    def __init__(self, texts: list[str], n: np.ndarray) -> None:
        self.texts, self.n = texts, n
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        letters = np.frombuffer("".join(texts).encode("latin-1"), np.uint8)
        row = np.repeat(np.arange(len(texts)), self.lengths)
        size = len(GROUPS) + 1
        counts = np.bincount(row * size + _GROUP_OF[letters], minlength=len(texts) * size)
        self.vectors = counts.reshape(-1, size)[:, DEALT:].astype(np.int32)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        short = np.repeat(self.lengths, self.lengths) <= _WIDE
        self.left = np.zeros((len(texts), _WIDE), np.uint8)
        self.left[row[short], place[short]] = letters[short]
        self.right = np.zeros((len(texts), _WIDE), np.uint8)
        behind = _WIDE - np.repeat(self.lengths, self.lengths) + place
        self.right[row[short], behind[short]] = letters[short]

    def taken(self, order: np.ndarray) -> _Words:
        return _Words([self.texts[i] for i in order.tolist()], self.n[order])


class Trie:
    """A block of words; a node is (first, last, level, children by count)."""

    def __init__(self, block: _Words) -> None:
        self.words = block.taken(np.lexsort(block.vectors.T[::-1]))
        self.root = self._node(0, len(block.texts), 0)

    def _node(self, first: int, last: int, level: int) -> tuple:
        vectors = self.words.vectors
        if last - first <= _LEAF or level == vectors.shape[1]:
            return first, last, level, None
        counts = vectors[first:last, level]
        cuts = [0, *(np.flatnonzero(np.diff(counts)) + 1).tolist(), last - first]
        return first, last, level, [
            (int(counts[a]), self._node(first + a, first + b, level + 1)) for a, b in zip(cuts, cuts[1:])
        ]

    def search(self, asked: _Words, surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of ``asked``, rows of the trie) whose vectors lie within the budgets.

        Depth first; all searches that are still alive go into a node together.
        """
        wanted = asked.vectors
        stack = [(self.root, np.arange(len(wanted)), surplus, deficit)]
        while stack:
            (first, last, level, children), alive, more, fewer = stack.pop()
            if children is None:
                found = self._within(first, last, level, wanted[alive], more, fewer)
                if len(found[0]):
                    yield alive[found[0]], found[1] + first
                continue
            counts = wanted[alive, level]
            for count, child in children:
                step = count - counts
                going = np.flatnonzero((step <= more) & (-step <= fewer))
                if len(going):
                    spent = step[going]
                    stack.append((child, alive[going], more[going] - (spent > 0), fewer[going] - (spent < 0)))

    def _within(self, first, last, level, wanted, more, fewer) -> tuple[np.ndarray, np.ndarray]:
        if last - first <= _LEAF:
            ok = np.ones((len(wanted), last - first), bool)
            added = np.zeros(ok.shape, np.int32)
            lost = np.zeros(ok.shape, np.int32)
            for k in range(level, wanted.shape[1]):
                step = self.words.vectors[first:last, k][None, :] - wanted[:, k][:, None]
                added += np.maximum(step, 0)
                lost += np.maximum(-step, 0)
            ok = (added <= more[:, None]) & (lost <= fewer[:, None])
            return np.nonzero(ok)
        rows = np.repeat(np.arange(len(wanted)), last - first)
        return rows, np.tile(np.arange(last - first), len(wanted))


def one_edit(x: str, y: str) -> bool:
    """Whether one code point inserted, deleted or replaced makes ``y`` of ``x``."""
    if x == y or abs(len(x) - len(y)) > 1:
        return False
    least = min(len(x), len(y))
    p = next((i for i in range(least) if x[i] != y[i]), least)
    if len(x) == len(y):
        return x[p + 1 :] == y[p + 1 :]
    return x[p + 1 :] == y[p:] if len(x) > len(y) else x[p:] == y[p + 1 :]


def _verified(a: _Words, i: np.ndarray, b: _Words, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (``a[i]``, ``b[j]``) are one edit apart."""
    la, lb = a.lengths[i], b.lengths[j]
    least = np.minimum(la, lb)
    alike = a.left[i] == b.left[j]
    before = np.where(alike.all(1), _WIDE, alike.argmin(1))
    alike = (a.right[i] == b.right[j])[:, ::-1]
    after = np.where(alike.all(1), _WIDE, alike.argmin(1))
    good = np.minimum(before, least) + np.minimum(after, least) >= np.where(la == lb, la - 1, least)
    good &= (np.abs(la - lb) <= 1) & ~((la == lb) & (before >= la))
    for k in np.flatnonzero(np.maximum(la, lb) > _WIDE).tolist():
        good[k] = one_edit(a.texts[i[k]], b.texts[j[k]])
    return good


_MET = "word string, n long, near string, near_n long"


def _near_pairs(trie: Trie, asked: _Words, surplus, deficit, both) -> Iterator[pa.RecordBatch]:
    """Pairs one edit apart; where ``both`` words ask for each other, in one order only."""
    found, size = [], 0

    def rows() -> pa.RecordBatch:
        i, j = (np.concatenate(x) for x in zip(*found))
        good = _verified(asked, i, trie.words, j)
        i, j = i[good], j[good]
        pairs = [(asked.texts[x], int(asked.n[x]), trie.words.texts[y], int(trie.words.n[y]))
                 for x, y in zip(i.tolist(), j.tolist()) if not both[x] or asked.texts[x] < trie.words.texts[y]]
        columns = list(zip(*pairs)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()) * 2)], names=["word", "n", "near", "near_n"]
        )

    for i, j in trie.search(asked, surplus, deficit):
        found.append((i, j))
        size += len(i)
        if size >= _PAIRS:
            yield rows()
            found, size = [], 0
    if found:
        yield rows()


def _search_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted: the words of a block, then the searches that go past it."""
    here, trie, block, asked = None, None, [], []

    def searched() -> Iterator[pa.RecordBatch]:
        nonlocal asked, trie, block
        if asked and block and trie is None:
            trie = Trie(_Words([b["word"] for b in block], np.array([b["n"] for b in block])))
            block = []
        if asked and trie is not None:
            own = _Words([a["word"] for a in asked], np.array([a["n"] for a in asked]))
            budgets = [np.array([a[c] for a in asked]) for c in ("surplus", "deficit")]
            yield from _near_pairs(trie, own, *budgets, (budgets[0] + budgets[1] == 2).tolist())
        asked = []

    for batch in batches:
        for row in batch.to_pylist():
            if here != (row["node"], row["block"]):
                yield from searched()
                here, trie, block = (row["node"], row["block"]), None, []
            if row["asks"]:
                asked.append(row)
                if len(asked) >= _SEARCHES:
                    yield from searched()
            else:
                block.append(row)
    yield from searched()


def _node(counts: list[Column]) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in counts])


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair one edit apart, once, in either order."""
    counts = [F.length("word") - F.length(F.translate("word", g, "")) for g in GROUPS[:DEALT]]
    levels = [f"c{i}" for i in range(DEALT)]
    placed = vocabulary.select("word", "n", *[c.alias(x) for c, x in zip(counts, levels)])
    moved = lambda steps: _node([F.col(x) + steps.get(i, 0) for i, x in enumerate(levels)])
    # A word asks where the first change it meets is a loss, or a gain made good later
    # among the dealt levels: the other word of such a pair does not ask back.
    routes = [({}, 1, 1)] + [({i: -1}, 1, 0) for i in range(DEALT)]
    routes += [({i: 1, j: -1}, 0, 0) for i in range(DEALT) for j in range(i + 1, DEALT)]
    asked = F.array(*[
        F.struct(moved(steps).alias("node"), F.lit(s).alias("surplus"), F.lit(d).alias("deficit")) for steps, s, d in routes
    ])
    own = placed.withColumn("node", moved({}))
    blocks = own.groupBy("node").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    kept = own.join(blocks, "node").select(
        "node", F.pmod(F.xxhash64("word"), "blocks").cast("int").alias("block"), F.lit(False).alias("asks"),
        "word", "n", F.lit(0).alias("surplus"), F.lit(0).alias("deficit"),
    )
    searches = placed.select("word", "n", F.inline(asked)).join(blocks, "node").select(
        "node", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("asks"),
        "word", "n", "surplus", "deficit",
    )
    tasks = 2 * int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = kept.unionByName(searches).repartition(tasks, "node", "block")
    return together.sortWithinPartitions("node", "block", "asks").mapInArrow(_search_subtrees, _MET)


# Groups -----------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word on the way from form to form.

    Each form is FACTOR times as frequent as its word, so a way has fewer than 19
    steps; the steps of each round are twice as long as those of the one before.
    """
    steps = reliable_copy(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = steps.join(ahead, "root", "left")
        longer = reliable_copy(joined.select("word", F.coalesce("next", "root").alias("root"), "next"))
        if longer.where("next IS NOT NULL").isEmpty():
            return steps
        steps = longer.drop("next")


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    Words are runs of Latin letters (A-Z in lower case) of MIN_LENGTH code points
    or more that occur MIN_COUNT times in all; one run in DAMAGE loses a code
    point first, as ``damaged`` has it.  Near words differ by one code point
    inserted, deleted or replaced.  ``form`` is the most frequent near word (of
    equal ones the first in code-point order) if it is FACTOR times as frequent,
    ``form_n`` its count; ``root`` is reached from form to form.

    NULL and empty texts have no words.  Every row counts, repeated ones, too; a
    NULL doc_id counts as an empty one in the hash.  Texts and words of any length
    are taken whole.  Only doc_id and text are read, whatever other columns are
    called.  An empty table has no words.
    """
    vocabulary = reliable_copy(words(docs))
    met = near_pairs(vocabulary).select(
        F.inline(
            F.array(
                F.struct("word", "n", "near", "near_n"),
                F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
            )
        )
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    found = met.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    usual = -F.col("best.less") >= FACTOR * F.col("n")
    formed = reliable_copy(found.select(
        "word", "n_near", F.when(usual, F.col("best.form")).alias("form"), F.when(usual, -F.col("best.less")).alias("form_n")
    ))
    rooted = roots(formed.where("form IS NOT NULL"))
    return vocabulary.join(formed, "word", "left").join(rooted, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
