import math
import random
import weakref
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallymark.llm import common, quality

N = quality.ORDER
SCHEMA = "doc_id long, text string, lang string, trusted string, score double"


def grams(text):
    raw = b"\x01" * (N - 1) + (text or "").encode() + b"\x02"
    return [raw[i : i + N] for i in range(len(raw) - N + 1)] if text else []


def kneser_ney(texts):
    """Probability function of the interpolated modified model, by plain dictionaries."""
    level = Counter(g for t in texts for g in grams(t))
    tables = {}
    for order in range(N, 0, -1):
        counts = Counter(level.values())
        n = [counts[i] for i in (1, 2, 3, 4)]
        if 0 in n:
            d = [0.5, 0.75, 0.9]
        else:
            y = n[0] / (n[0] + 2 * n[1])
            d = [i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)]
            d = [min(max(x, 0.05), 0.95 * (i + 1)) for i, x in enumerate(d)]
        totals, left = Counter(), defaultdict(float)
        for g, c in level.items():
            totals[g[:-1]] += c
            left[g[:-1]] += d[min(c, 3) - 1]
        tables[order] = (level, totals, left, d)
        level = Counter(g[1:] for g in level)

    def p(gram):
        value = 1 / 256
        for order in range(1, N + 1):
            g = gram[N - order :]
            level, totals, left, d = tables[order]
            total = totals.get(g[:-1])
            if total:
                c = level.get(g, 0)
                value = (max(0.0, c - d[min(c, 3) - 1]) / total if c else 0.0) + left[g[:-1]] / total * value
        return value

    return p


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    syllables = ["ka", "lo", "mi", "ter", "an", "que", "é"]
    prose = lambda n: " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))
    rows = [(i, prose(rng.randint(3, 60)), "aa" if i % 3 else "bb", "own", 9.0) for i in range(120)]
    rows += [(200 + i, prose(20).replace(" ", "%%% "), "aa", "own", 9.0) for i in range(10)]
    rows += [(300, None, "aa", "own", 9.0), (301, "", "bb", "own", 9.0), (302, "ka", None, "own", 9.0), (303, "\U0001f600", "zz", "own", 9.0),
             (None, prose(30), "aa", "own", 9.0), (304, prose(9000), "aa", "own", 9.0), (305, rows[0][1], "aa", "own", 9.0), (305, rows[0][1], "aa", "own", 9.0)]
    labels = [(i, 1, 0) for i in range(100)] + [(200, 0, 0), (None, 1, 0), (5, 1, 0), (7, None, 1)]
    return rows, labels


def test_scores_follow_the_model(spark, corpus):
    common.on_workers(spark)
    rows, labels = corpus
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.scores(docs, marks).collect()
    assert len(got) == len(rows)
    fold = {
        r.doc_id for r in docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % quality.FOLDS == 0).collect()
    }
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    p = kneser_ney([t for i, t, *_ in rows if i in good and i not in fold])
    texts = {(i, t) for i, t, *_ in rows}
    nats = {}
    for i, t in texts:
        nats[i] = (sum(-math.log(p(g)) for g in grams(t)), len(grams(t)))
    means = {"aa": [], "bb": []}
    for i, _, lang, *_ in rows:
        if i in good and i in fold:
            means[lang].append(nats[i][0] / nats[i][1])
    usual = {}
    for lang, values in means.items():
        usual[lang] = sorted(values)[math.ceil(len(values) / 2) - 1]
    for r in got:
        total, n = nats[r.doc_id]
        assert r.n_bytes == n
        if n == 0:
            assert r.score is None and r.rejected
        elif r.lang in usual:
            expected = (total + quality.PRIOR_BYTES * usual[r.lang]) / (n + quality.PRIOR_BYTES)
            assert r.score == pytest.approx(expected, abs=2 / quality.STEPS)
            assert r.rejected == (r.score > r.threshold)
        else:
            assert r.threshold is not None
    assert all(r.rejected for r in got if r.doc_id and 200 <= r.doc_id < 210)
    kept = quality.accepted(docs, marks)
    assert kept.columns == docs.columns and kept.count() == sum(not r.rejected for r in got)


def test_shards_add_up(spark, corpus, monkeypatch):
    rows, labels = corpus
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    key = lambda r: (str(r.doc_id), r.text_key)
    whole = sorted(quality.scores(docs, marks).collect(), key=key)
    monkeypatch.setattr(quality, "SHARD_ROWS", 700)
    parts = sorted(quality.scores(docs, marks).collect(), key=key)
    assert {(r.doc_id, r.score and round(r.score, 6), r.rejected) for r in whole} == {
        (r.doc_id, r.score and round(r.score, 6), r.rejected) for r in parts
    }
    assert len(whole) == len(parts) == len(rows)
    for a, b in zip(whole, parts):
        assert (a.doc_id, a.n_bytes, a.rejected, a.threshold) == (b.doc_id, b.n_bytes, b.rejected, b.threshold)
        assert a.score == (b.score and pytest.approx(b.score, abs=1e-6))


def test_repeated_rows_count_in_every_quantile(spark, monkeypatch):
    """Held-out rows that repeat a document weigh as many rows with any number of shards."""
    rows = [(i, "ka lo mi " * (1 + i % 7) + "ter" * (i % 5), "aa", "own", 9.0) for i in range(60)]
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % quality.FOLDS == 0
    held = min(r.doc_id for r in spark.createDataFrame(rows, SCHEMA).where(fold).collect())
    rows += [(held, "zz qq xx ww " * 9, "aa", "own", 9.0)] * 40
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    whole = [r.threshold for r in quality.scores(docs, marks).collect()]
    monkeypatch.setattr(quality, "SHARD_ROWS", 20)
    parts = [r.threshold for r in quality.scores(docs, marks).collect()]
    assert len(whole) == len(parts) == len(rows) and set(whole) == set(parts)


def test_without_labels_or_documents(spark, corpus):
    docs = spark.createDataFrame(corpus[0], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.scores(docs, none).collect()
    assert all(r.rejected == (not r.n_bytes) for r in got)
    assert quality.scores(docs.limit(0), none).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, marks = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    train = marks.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    rows = quality.scores(docs, train).join(marks.join(train, "doc_id", "left_anti"), "doc_id").collect()
    good = [r.rejected for r in rows if r.quality == 1]
    bad = [r.rejected for r in rows if r.quality == 0]
    assert sum(good) <= 0.08 * len(good) and sum(bad) >= 0.75 * len(bad)


def test_held_out_accuracy_of_a_small_table(spark):
    """Too few held-out documents by language for a quantile of each: that of all holds."""
    folder = "/root/testdata/sf0.01"
    docs, marks = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    train = marks.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    rows = quality.scores(docs, train).join(marks.join(train, "doc_id", "left_anti"), "doc_id").collect()
    good = [r.rejected for r in rows if r.quality == 1]
    bad = [r.rejected for r in rows if r.quality == 0]
    assert sum(good) <= 0.08 * len(good) and sum(bad) >= 0.75 * len(bad)
    assert len({r.threshold for r in rows}) == 1


def test_counting_begins_without_the_words_of_packing():
    import public_tokenizers

    from tallymark.llm import packing

    path = public_tokenizers.path("word_bpe_49k.json")
    words = weakref.ref(packing._tokenizer(path))
    assert packing._tokenizer(path) is words()  # tasks of packing share them
    batch = pa.RecordBatch.from_arrays([pa.array(["abab", "abab", "b", None]), pa.array([True, True, False, True])], names=["text", "train"])
    run, _ = quality._counter()
    rows = [r for out in run([batch]) for r in out.to_pylist()]
    assert words() is None
    grams, sizes = quality._grams(["abab"])
    counted = {r["gram"]: r["times"] for r in rows}
    assert len(counted) == len(rows) and all(counted[g] == 2 for g in grams.tolist()) and sizes.tolist() == [5]
    assert sum(counted.values()) == 10 and 0 in counted.values()
