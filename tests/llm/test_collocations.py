import random
import re
from collections import Counter

import pytest

from tallymark.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, n string, bucket string, rank string"


def brute(rows, min_count=10, per_lang=2000):
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    out = []
    for lang in totals:
        best = []
        for (other, w), a in counts.items():
            if other != lang or len(w) < 2 or a < min_count:
                continue
            longer = [n for (x, p), n in counts.items()
                      if x == lang and len(p) == 3 and len(w) == 2 and w in (p[:2], p[1:])]
            if any(n >= min_count and 100 * n >= 50 * a for n in longer):
                continue
            cuts = []
            for k in range(1, len(w)):
                left, right = counts[lang, w[:k]], counts[lang, w[k:]]
                cuts.append((1000000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            best.append((-score, -a, " ".join(w).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:per_lang], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def result(spark, rows, per_lang=2000):
    found = collocations.top(collocations.collocations(spark.createDataFrame(rows, SCHEMA)), per_lang)
    return sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed, n=60):
    rng = random.Random(seed)
    words = ["a", "bb", "C", "dD", "É", "x y", " ", "ab-c", "'", "e"]
    marks = [" ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "?", " : "]
    rows = []
    for doc in range(n):
        text = "".join(rng.choice(words) + rng.choice(marks[:3] * 3 + marks) for _ in range(rng.randint(0, 60)))
        rows.append((doc, text, rng.choice(["en", "en", "en", "de", None]), "p", "n", "b", "r"))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_brute_force(spark, seed):
    rows = texts(seed)
    expected = brute(rows)
    assert expected and result(spark, rows) == expected


def test_small_flushes_and_slices_give_the_same(spark, monkeypatch):
    rows = texts(7)
    done = []
    stripes = collocations.Stripes(3)
    monkeypatch.setattr(collocations, "_FLUSH", 11)
    monkeypatch.setattr(collocations, "_SLICE", 7)
    for _, text, lang, *_ in rows:
        done += stripes.add(lang or "und", (text or "").encode())
    done += stripes.flush()
    got = Counter()
    for batch in done:
        for row in batch.to_pylist():
            for phrase, n in zip(row["phrases"].split("\n"), row["times"]):
                got[row["lang"], phrase] += n
    whole = collocations.counts(spark.createDataFrame(rows, SCHEMA), min_count=1).collect()
    assert {(r.lang, r.phrase): r.n for r in whole} == {k: n for k, n in got.items()}


def test_words_keep_their_language_over_a_flush(monkeypatch):
    monkeypatch.setattr(collocations, "_FLUSH", 3)
    stripes, got = collocations.Stripes(2), Counter()
    done = [b for lang, text in (("en", b"one two"), ("de", b" "), ("fr", b""), ("de", b"drei")) for b in stripes.add(lang, text)]
    for batch in [*done, *stripes.flush()]:
        for row in batch.to_pylist():
            for phrase, n in zip(row["phrases"].split("\n"), row["times"]):
                got[row["lang"], phrase] += n
    assert {k: n for k, n in got.items() if n} == {
        ("en", ""): 2, ("en", "one"): 1, ("en", "two"): 1, ("en", "one two"): 1, ("de", ""): 1, ("de", "drei"): 1}


def test_ties_top_and_repeated_rows(spark):
    rows = [(1, "q w. q w. z y. z y. ", "en", "p", "n", "b", "r")] * 5
    got = result(spark, rows)
    assert got == brute(rows) and [r[2] for r in got] == ["q w", "z y"]
    assert [r[2] for r in result(spark, rows, per_lang=1)] == ["q w"]


def test_odd_rows(spark):
    assert result(spark, []) == []
    blank = [(None, None, None, "p", "n", "b", "r"), (1, "", "en", "p", "n", "b", "r"), (2, " .\n\t", "en", "p", "n", "b", "r")]
    assert result(spark, blank) == []
    long = [(3, "one two " * 30_000, "en", "p", "n", "b", "r"), (4, "w" * 100_000, None, "p", "n", "b", "r")]
    assert result(spark, long) == brute(long)


def test_large_counts_are_exact(spark):
    sums = spark.createDataFrame([("en", "a b", 9 * 10**12, 10**13, 10**13)], "lang string, phrase string, a long, l long, r long")
    score = collocations.score("a", "l", "r")
    assert sums.select(score.alias("s")).first().s == 1000000 * (9 * 10**12) ** 2 // 10**26
