import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallymark.llm import variants

SCHEMA = "doc_id long, text string, word string, n string, node string, form string, root string"
OWN = ("w", "n", "o", "f", "r")


def near(x, y):
    if x == y or abs(len(x) - len(y)) > 1:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    if len(x) < len(y):
        x, y = y, x
    return any(x[:i] + x[i + 1 :] == y for i in range(len(x)))


def brute(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    met = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w in counts:
        best = min(met[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), counts[w], len(met[w]), counts[form[w]] if form[w] else 0) for w in counts)


def result(spark, rows):
    found = variants.variants(spark.createDataFrame(rows, SCHEMA))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in found.collect())


def typed(seed, docs=150, letters="etnaié×xq"):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 10))) for _ in range(50)]
    rows = []
    for doc in range(docs):
        words = []
        for _ in range(50):
            word = base[int(len(base) * rng.random() ** 3)]
            while rng.random() < 0.25:
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", rng.choice(letters), rng.choice(letters) + word[at]]) + word[at + 1 :]
            words.append(word.upper() if rng.random() < 0.1 and "é" not in word else word)
        rows.append((doc, rng.choice([" ", ", ", "1", "\n"]).join(words), *OWN))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_brute_force(spark, seed):
    rows = typed(seed)
    expected = brute(rows)
    assert len(expected) > 100 and sum(r[1] != "" for r in expected) > 50
    assert result(spark, rows) == expected


def test_small_blocks_and_batches_give_the_same(spark, monkeypatch):
    expected = result(spark, typed(5))
    monkeypatch.setattr(variants, "BLOCK", 7)
    assert result(spark, typed(5)) == expected


def test_forms_lead_to_roots(spark):
    text = " ".join(["spelling"] * 1000 + ["speling"] * 100 + ["spelin"] + ["spelingg"] * 10 + ["aspelingg"] * 2)
    expected = brute([(3, text)])
    got = result(spark, [(3, text, *OWN)])
    assert got == expected and max(len(set(x[:3])) for x in got) == 3


def test_long_words(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh") for _ in range(30_000))
    words = [long, long[:-1], "x" + long[1:], "b" * 65, "b" * 64, "b" * 63, "b" * 62 + "cc", "b" * 63 + "c"]
    rows = [(1, " ".join(words * 2), *OWN)]
    assert result(spark, rows) == brute(rows)


def test_odd_rows(spark):
    assert result(spark, []) == []
    rows = [(None, "lettering lettering", *OWN), (None, None, *OWN), (2, "", *OWN), (2, "short ones 1234567 ÀÉÎÕÜÝß ÀÉÎÕÜÝß àéîõüýß", *OWN)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows * 2) == brute(rows * 2)


def test_search_keeps_what_a_plain_comparison_keeps():
    rng = random.Random(4)
    texts = sorted({"".join(rng.choice("etc") for _ in range(rng.randint(7, 9))) for _ in range(400)})
    block = variants._Words(texts, np.ones(len(texts), np.int64))
    trie, ones = variants.Trie(block), np.ones(len(texts), np.int64)
    got = set()
    for i, j in trie.search(block, ones, ones):
        good = variants._verified(block, i, trie.words, j)
        got |= {(texts[x], trie.words.texts[y]) for x, y in zip(i[good].tolist(), j[good].tolist())}
    assert got == {(x, y) for x in texts for y in texts if near(x, y)}
    assert all(variants.one_edit(x, y) == near(x, y) for x in texts[:80] for y in texts)
