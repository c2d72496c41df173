import random

import numpy as np
import pyarrow as pa
import pytest

from tallymark.llm import jaccard
from tallymark.llm.shingles import shingle_sets, signature

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, node string"


def shingles(text):
    words = (text or "").translate(LOWER).encode().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    low = [i for i, _ in sets]
    changed = True
    while changed:
        changed = False
        for a, (_, x) in enumerate(sets):
            for b in range(a):
                y = sets[b][1]
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    m = min((v for v in (low[a], low[b]) if v is not None), default=None)
                    changed |= low[a] != m or low[b] != m
                    low[a] = low[b] = m
    return sorted(((i, len(s), c) for (i, s), c in zip(sets, low)), key=str)


def got(spark, rows):
    df = jaccard.classes(spark.createDataFrame(rows, SCHEMA))
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def family(rng, n, edits):
    base = [f"w{rng.randrange(4000)}" for _ in range(n)]
    for _ in range(edits):
        base[rng.randrange(n)] = f"e{rng.randrange(9000)}"
    return base


@pytest.mark.parametrize("seed, seen", [(0, 2), (1, 2), (2, 100)])
def test_brute_force(spark, monkeypatch, seed, seen):
    """Families of copies, a passage in many texts, chains; with and without known frequent tokens."""
    monkeypatch.setattr(jaccard, "_SEEN", seen)
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for f in range(6):
        base = family(rng, rng.choice([20, 60, 150]), 0)
        for _ in range(rng.choice([2, 12])):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(9000)}"
            rows.append(copy)
    for _ in range(15):
        rows.append(family(rng, 50, 0) + passage)
    chain = family(rng, 100, 0)
    for step in range(8):
        chain = chain[:-2] + [f"c{step}", f"d{step}"] if step % 2 else [f"c{step}"] + chain[1:]
        rows.append(list(chain))
    table = [(i * 3, " ".join(w), "x") for i, w in enumerate(rows)]
    table += [(1000, table[3][1].upper(), "x"), (1001, "one two", "x"), (1002, "One\ttwo", "x"), (1003, "one three", "x")]
    assert got(spark, table) == brute(table)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(20000))
    rows = [
        (5, None, "x"), (4, "", "x"), (3, " \n ", "x"), (None, "a b c d e f", "x"), (9, "a b c d e f", "x"),
        (2, long, "x"), (1, long + " tail", "x"), (8, "same same same same same same", "x"), (8, "other words", "x"),
        (7, "repeated row here", "x"), (7, "repeated row here", "x"),
    ]
    assert got(spark, rows) == brute(rows)
    kept = jaccard.one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "node"]
    left = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    expected = [(5, None), (4, ""), (3, " \n "), (9, "a b c d e f"), (1, long + " tail"),
                (8, "same same same same same same"), (8, "other words"), (7, "repeated row here")]
    assert left == sorted(expected, key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert jaccard.classes(docs).count() == 0 and jaccard.one_of_each(docs).count() == 0


def test_shingle_sets_do_not_depend_on_batches(monkeypatch):
    texts = ["a b c d e f", None, "", "x", "é ü ö ä ß ç", "A B C D E F", "a b c d e f g" * 50, "  a   b c\td e f "]
    whole = [s.tolist() for s in shingle_sets(pa.array(texts))]
    assert whole[0] == whole[5] == whole[7] and [len(s) for s in whole] == [len(shingles(t)) for t in texts]
    monkeypatch.setattr("tallymark.llm.shingles._SLICE", 7)
    assert [s.tolist() for s in shingle_sets(pa.array(texts))] == whole
    assert [s.tolist() for s in shingle_sets(pa.array(["z", *texts]).slice(1))] == whole
    assert signature(np.array(whole[0], np.uint64)) == signature(np.array(whole[5], np.uint64))
