import random

import pytest

from tallymark.llm import line_dedup

SCHEMA = "doc_id long, text string, n_lines string"


def near(x, y):
    """Levenshtein distance over words of at most one."""
    if abs(len(x) - len(y)) > 1:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) <= 1
    if len(x) > len(y):
        x, y = y, x
    return any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def brute(rows):
    seen, out = [], {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        if text is None:
            out[doc_id] = None
            continue
        keep = []
        for line in text.split("\n"):
            words = line.lower().split()
            if len(words) >= line_dedup.MIN_WORDS:
                drop = any(near(words, other) for other in seen)
                seen.append(words)
                if drop:
                    continue
            keep.append(line)
        out[doc_id] = "\n".join(keep)
    return out


def result(spark, rows):
    df = line_dedup.deduplicated(spark.createDataFrame(rows, SCHEMA))
    assert df.columns[:2] == ["doc_id", "text"]
    return {r.doc_id: r.text for r in df.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_brute_force(spark, seed):
    rng = random.Random(seed)
    words = ["a", "bb", "c", "dd", "é"]
    base = [[rng.choice(words) for _ in range(rng.randint(1, 11))] for _ in range(25)]
    rows = []
    for doc in range(40):
        lines = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2])):
                kind, at = rng.randint(0, 2), rng.randrange(len(line) + 1)
                if kind == 0:
                    line.insert(at, rng.choice(words))
                elif line and at < len(line):
                    line[at : at + 1] = [] if kind == 1 else [rng.choice(words)]
            lines.append(rng.choice([" ", "  ", "\t"]).join(line).upper() if rng.random() < 0.3 else " ".join(line))
        rows.append((doc, "\n".join(lines), "own"))
    rows.append((40, None, "own"))
    assert result(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [
        (1, "one two three four five\n\nDie.\nDie.", "x"),
        (2, "one two three four six\nDie.", "x"),
        (3, "", "x"),
        (4, long, "x"),
        (5, long + " more", "x"),
        (None, "one two three four five", "x"),
    ]
    got = result(spark, rows)
    assert got[1] == "one two three four five\n\nDie.\nDie."
    assert got[2] == "Die." and got[3] == "" and got[4] == long and got[5] == "" and got[None] == ""


def test_repeated_rows_are_one_document(spark):
    rows = [(1, "one two three four five", "x")] * 2 + [(2, "one two three four five", "x")]
    df = line_dedup.deduplicated(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.doc_id, r.text) for r in df.collect()) == [(1, rows[0][1])] * 2 + [(2, "")]


def test_empty_table(spark):
    assert line_dedup.deduplicated(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_lines_of_few_words(spark):
    han, url = "".join(chr(0x4E00 + i) for i in range(80)), "https://example.org/" + "path/" * 20
    four = "internationalization administration responsibilities "
    rows = [(1, f"{han}\n{url}\n{four}alpha\nshort line", "x"),
            (2, f"{url.upper()}\nown\n{han}\n{han}x\n{four}beta\nshort line", "x"), (3, f"{four}  alpha\n{url}y", "x")]
    got = result(spark, rows)
    assert got[1] == rows[0][1]
    assert got[2] == f"own\n{han}x\n{four}beta\nshort line" and got[3] == f"{url}y"


def test_lines_are_normalized_once_when_texts_are_rebuilt(spark):
    docs = spark.createDataFrame([(1, "one two three four five six\nShort"), (2, "ONE two three four  five six\nshort")], "doc_id long, text string")
    got = line_dedup.deduplicated(docs)
    assert {(r.doc_id, r.text) for r in got.collect()} == {(1, "one two three four five six\nShort"), (2, "short")}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1
