import hashlib

import pytest

from tallymark.llm import fingerprints

K, W = fingerprints.K, fingerprints.WINDOW


def run(spark, rows):
    df = fingerprints.edited_pairs(spark.createDataFrame(rows, "doc_id long, text string, next string"))
    return df.select(
        "*",
        fingerprints.as_text("chosen").alias("fp"),
        fingerprints.hashes("chosen").alias("hashes"),
        fingerprints.places("chosen").alias("places"),
        fingerprints.likeness("chosen", "edited_chosen").alias("near_edited"),
        fingerprints.likeness("chosen", "next_chosen").alias("near_next"),
    ).collect()


def edited(text, other):
    m = len(text) // 3
    return text[: len(text) - m] + other[:m]


def test_edited_texts(spark):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id * 7, r.text, "x") for r in source] + [(-5, "", "x"), (3, None, "x"), (-9, "ab", "x")]
    got = {r.doc_id: r for r in run(spark, rows)}
    order = sorted(((i, t or "") for i, t, _ in rows), reverse=True)
    assert len(got) == len(order)
    by_text = {}
    for (i, text), (j, other) in zip(order, order[1:] + order[:1]):
        assert got[i].text == text and got[i].edited == edited(text, other)
        assert got[i].next_chosen == got[j].chosen
        assert by_text.setdefault(text, got[i].fp) == got[i].fp
        a, b, c = (set(x) for x in (got[i].chosen, got[i].edited_chosen, got[i].next_chosen))
        top = lambda s: {v >> 27 for v in s}
        assert got[i].near_edited == pytest.approx(len(top(a) & top(b)) / len(top(a) | top(b)))
        assert got[i].near_next == pytest.approx(len(top(a) & top(c)) / len(top(a) | top(c)))


def winnowed(values, window):
    """Smallest of every window, the rightmost of equals: (value, place)."""
    chosen = []
    for j in range(max(1, len(values) - window + 1)):
        part = list(enumerate(values))[j : j + window]
        place, value = min(part, key=lambda p: (p[1], -p[0]))
        if (value, place) not in chosen:
            chosen.append((value, place))
    return chosen


def test_winnowing_rule(spark):
    text = " ".join(f"w{i * i % 23}" for i in range(200)) + " same same same same same same same same same " * 4
    row = run(spark, [(1, text, "x")])[0]
    every = fingerprints.with_chosen(spark.createDataFrame([(text,)], "text string"), "text", "c", K, 1).select(
        fingerprints.hashes("c").alias("h")).first().h
    assert list(zip(row.hashes, row.places)) == winnowed(every, W)


def test_shared_run_is_found(spark):
    shared = " ".join(f"s{i}" for i in range(K + W - 1))
    rows = [(2, "a b c d " + shared + " e f g", "x"), (1, "p q " + shared + " r s t u v", "x")]
    assert min(r.near_next for r in run(spark, rows)) > 0


def test_repeated_rows_one_row_and_none(spark):
    assert len(run(spark, [(1, "a b c", "x")] * 3 + [(None, "d e f", "x")])) == 4
    only = run(spark, [(1, "abcdef", "x")])[0]
    assert only.edited == "abcdab" and hashlib.sha256(only.edited.encode()).hexdigest()
    assert run(spark, []) == []


def test_text_without_blanks_keeps_its_tokens_beside_prose(spark):
    block = "".join(chr(0x4E00 + i * i % 5003) for i in range(3000))
    prose = " ".join(f"word{i}" for i in range(400))
    got = {r.doc_id: r for r in run(spark, [(2, block, "x"), (1, prose, "x")])}
    assert got[2].edited == block[:2000] + prose[:1000]
    shared = len(set(got[2].hashes) & {v >> 27 for v in got[2].edited_chosen})
    assert shared >= 0.6 * len(got[2].hashes) and got[2].near_edited > 0.5
