"""Toxicity score from a weighted lexicon matched by Aho-Corasick.

Texts are folded first: lower case, look-alike letters and digits to the letters
they stand for, everything else to blanks.  Lexicon entries are beginnings of
words with weights; at every word the longest entry counts.  Exception phrases
are entries of weight 0, so that a longer harmless phrase hides the entry in it.
The sum of weights, set against the number of words in two ways, goes through a
logistic curve.  Entries, weights and curve are learned from labelled texts.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm import common
from tallymark.session import reliable_copy

# At most about so many labelled texts of each label are learned from.
SAMPLE = 15_000
MIN_TEXTS = 4
MIN_LIFT = 6.0
SHORTEST, LONGEST = 3, 10

# Letters and signs that stand for a Latin letter.
_LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ј": "j", "ѕ": "s", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ł": "l", "ø": "o",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l",
}
# Harmless phrases with words that may be in a lexicon.
EXCEPTIONS = (
    "clown fish", "clownfish", "trash can", "trash bin", "pond scum", "mother lode", "sore loser board game",
)
_HIDDEN = dict.fromkeys(map(ord, "­​‌‍⁠﻿"))


def _folding() -> dict[int, str | None]:
    table = {ord(a): b for a, b in _LOOKALIKES.items()}
    return table | _HIDDEN


_FOLD = _folding()


def folded(text: str | None) -> str:
    """Words of the text in folded form, each with a blank before it.

    A sign that stands for a letter counts as one only inside or before a word:
    ``!`` and ``|`` at a word's end are punctuation.
    """
    words = []
    for word in unicodedata.normalize("NFKC", text or "").lower().split():
        word = word.strip("!|.,;:?\"'()[]{}<>#%&*")
        if word.isascii() and word.isalpha():
            words.append(word)
            continue
        word = word.translate(_FOLD)
        words.extend("".join(c if c.isalpha() else " " for c in word).split())
    return " " + " ".join(words)


@dataclass(frozen=True)
class Toxicity:
    """A learned scorer; small enough to travel with every task."""

    weights: dict[str, float]  # word beginning -> weight, 0 for exceptions
    curve: tuple[float, ...]  # intercept and the factors of the features

    def matcher(self) -> ahocorasick.Automaton:
        return _automaton(self.weights)


def _automaton(weights: dict[str, float]) -> ahocorasick.Automaton | None:
    if not weights:
        return None
    found = ahocorasick.Automaton()
    for entry, weight in weights.items():
        found.add_word(" " + entry, (entry, weight))
    found.make_automaton()
    return found


def features(text: str | None, matcher: ahocorasick.Automaton | None) -> list[float]:
    """Weight found, the same per word of a text and per root of its words."""
    plain = folded(text)
    n = plain.count(" ") if len(plain) > 1 else 0
    total = sum(w for _, (_, w) in matcher.iter_long(plain)) if matcher else 0.0
    return [math.log1p(total), 100 * total / (n + 20), total / math.sqrt(n + 20)]


_COUNTS = "entry string, toxic int, texts long, hits long"
_HELD = 500_000  # entries that a task counts before it hands them on


def _count_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and hits of every beginning of a word, by label; words under the entry ``""``."""
    texts: Counter[tuple[str, int]] = Counter()
    hits: Counter[tuple[str, int]] = Counter()
    words: Counter[int] = Counter()
    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
            own: Counter[str] = Counter()
            plain = folded(text.as_py()).split()
            for word, times in Counter(plain).items():
                for n in range(SHORTEST, min(len(word), LONGEST) + 1):
                    own[word[:n]] += times
            words[label] += len(plain)
            for entry, times in own.items():
                texts[entry, label] += 1
                hits[entry, label] += times
            if len(texts) > _HELD:
                yield _rows(texts, hits)
                texts, hits = Counter(), Counter()
    yield _rows(texts, hits)
    yield _rows(Counter({("", label): 0 for label in words}), Counter({("", label): n for label, n in words.items()}))


def _rows(texts: Counter[tuple[str, int]], hits: Counter[tuple[str, int]]) -> pa.RecordBatch:
    keys = list(texts)
    return pa.RecordBatch.from_arrays(
        [pa.array([e for e, _ in keys], pa.string()), pa.array([t for _, t in keys], pa.int32()),
         pa.array([texts[k] for k in keys], pa.int64()), pa.array([hits[k] for k in keys], pa.int64())],
        names=["entry", "toxic", "texts", "hits"])


def _featured(matcher_of: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _automaton(matcher_of)
        for batch in batches:
            rows = [features(t.as_py(), matcher) for t in batch.column("text")]
            columns = [pa.array([r[i] for r in rows], pa.float64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *columns], names=["toxic", "f0", "f1", "f2"])

    return run


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic): labelled texts, of each label about ``sample`` at most.

    Which ones follows from a hash of the id alone.  An id with both labels is
    toxic.
    """
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy(
        F.col("doc_id").alias("labelled_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    part = F.pmod(F.xxhash64(F.lit("sample"), "labelled_id"), F.lit(1_000_000))
    share = F.lit(0)
    for label, n in sizes.items():
        share = F.when(F.col("toxic") == label, F.lit(min(1_000_000, sample * 1_000_000 // n))).otherwise(share)
    chosen = common.broadcast_if_small(known.where(part < share))
    texts = docs.select("doc_id", "text")
    return texts.join(chosen, texts["doc_id"] == chosen["labelled_id"]).select("text", "toxic")


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Toxicity:
    """Learn entries, weights and curve from the labelled rows of ``docs``.

    Without texts of both labels nothing is known: every score is then 0.
    """
    texts = reliable_copy(labelled_sample(docs, labels, sample))
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Toxicity({}, (-10.0, 0.0, 0.0, 0.0))
    by_label = [
        F.sum(F.when(F.col("toxic") == label, F.col(c)).otherwise(0)).alias(f"{c}{label}")
        for c in ("texts", "hits") for label in (0, 1)
    ]
    counted = reliable_copy(texts.mapInArrow(_count_hits, _COUNTS).groupBy("entry").agg(*by_label))
    weights = _weights(counted, sizes)
    matched = {e: w for e, w in weights.items()} | {
        e: 0.0 for e in (folded(x)[1:] for x in EXCEPTIONS)
    }
    table = texts.mapInArrow(_featured(matched), "toxic int, f0 double, f1 double, f2 double")
    vectors = VectorAssembler(inputCols=["f0", "f1", "f2"], outputCol="features").transform(reliable_copy(table))
    fit = LogisticRegression(labelCol="toxic", maxIter=200, regParam=1e-4).fit(vectors)
    return Toxicity(matched, (float(fit.intercept), *map(float, fit.coefficients)))


def _weights(counted: DataFrame, sizes: dict[int, int]) -> dict[str, float]:
    """entry -> weight: the logarithm of how much denser hits are in toxic texts.

    Entries must be clearly more usual in toxic texts.  All that are come to the
    driver: the bounded sample bounds them.
    """
    words = counted.where("entry = ''").first()
    words0, words1 = max(1, words["hits0"]), max(1, words["hits1"])
    dense = ((F.col("hits1") + 0.5) / words1) / ((F.col("hits0") + 0.5) / words0)
    usual = ((F.col("texts1") + 0.5) / sizes[1]) / ((F.col("texts0") + 0.5) / sizes[0])
    clear = (F.col("texts1") >= MIN_TEXTS) & (F.col("lift") >= MIN_LIFT) & (F.col("usual") > 2)
    chosen = counted.select("entry", "texts1", usual.alias("usual"), F.sqrt(dense * usual).alias("lift")).where(clear)
    found = {r.entry: (r.texts1, math.log(r.lift)) for r in chosen.select("entry", "texts1", "lift").collect()}
    # A beginning says nothing of its own when one longer entry stands for nearly all its texts.
    longer: Counter[str] = Counter()
    for entry, (t1, _) in found.items():
        for n in range(SHORTEST, len(entry)):
            longer[entry[:n]] = max(longer[entry[:n]], t1)
    return {e: w for e, (t1, w) in sorted(found.items()) if longer[e] < 0.9 * t1}


def _scorer(model: Toxicity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, (start, *factors) = model.matcher(), model.curve
        for batch in batches:
            scores = []
            for text in batch.column("text"):
                z = start + sum(a * b for a, b in zip(factors, features(text.as_py(), matcher)))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def scored(docs: DataFrame, model: Toxicity) -> DataFrame:
    """(doc_id, score): of every row, from its whole text alone, 0 to 1.

    NULL, empty and very short texts get the score of a text without any entry.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_scorer(model), "doc_id long, score double")
