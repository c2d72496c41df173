import re

from tallymark.llm import licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text):
    own, base, labels, score = words(text), [], set(), 0.0
    for phrase, label in licenses.BASE:
        w = phrase.split()
        places = [i for i in range(len(own)) if own[i : i + len(w)] == w]
        base += [(i, label) for i in places]
        score = max(score, 1.0 if places else 0.0)
    for label, template, key in licenses.TEMPLATES:
        w, k = template.split(), key.split()
        at = next(i for i in range(len(w)) if w[i : i + len(k)] == k)
        for i in range(len(own)):
            there = own[i : i + len(w)]
            share = sum(a == b for a, b in zip(there, w)) / len(w)
            if share >= licenses.MIN_SHARE and there[at : at + len(k)] == k:
                labels.add(label)
                score = max(score, share)
    return (
        len(own), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None),
        sorted({x for _, x in base}), sorted({x for _, x in base} | labels), round(score, 9),
    )


def test_brute_force(spark):
    rows = [
        (i, r.text, "x") for i, r in enumerate(
            spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect())
    ]
    rows += [
        (1000, None, "x"), (1001, "", "x"), (1002, "...", "x"), (None, "cc by", "x"), (1003, "CC-BY CC BY-SA 4.0", "x"),
        (1004, "Licensed under the Apache Licence, Apache License, Version 2.0", "x"),
        (1005, "GNU General Public License as distributed by the Free Software Foundation; either version 2", "x"),
        (1006, "PERMISSION is hereby granted, free of charge, to any man obtaining a copy", "x"),
        (1007, "The MIT License and the mit license İ ſ", "x"), (1008, "general public license gnu", "x"),
        (1009, "word " * 30000 + "gnu general public license version 3", "x"),
    ]
    df = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, label string"))
    got = {
        r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9))
        for r in df.collect()
    }
    assert got == {i: brute(t) for i, t, _ in rows}
    assert got[1003][5] == ["cc-by", "cc-by-sa"]


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "mit license"), (1, "mit license"), (1, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.n_base for r in licenses.scan(docs).collect()) == [0, 1, 1]
    assert licenses.scan(docs.limit(0)).count() == 0
