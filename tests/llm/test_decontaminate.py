import re

from tallymark.llm import decontaminate

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string, item_id string", "item_id long, text string, doc_id string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items):
    found = []
    for doc_id, text, _ in docs:
        own, hit, names = words(text), set(), set()
        for item_id, item, _ in items:
            w = words(item)
            for i in range(max(1, len(w) - 12) if w else 0):
                window = w[i : i + 13]
                for p in range(len(own) - len(window) + 1):
                    if own[p : p + len(window)] == window:
                        hit |= set(range(p, p + len(window)))
                        names.add(str(item_id))
        found.append((doc_id, len(own), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(found, key=str)


def got(spark, docs, items):
    df = decontaminate.report(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.items, r.contaminated) for r in df.collect()), key=str)


def test_brute_force_and_odd_rows(spark):
    text = " ".join(f"w{i % 17}" for i in range(40))
    items = [
        (1, text, "x"), (2, "Short item", "x"), (3, None, "x"), (4, "...", "x"), (5, "", "x"), (1, "again one", "x"),
        (2, "Short item", "x"), (11, " ".join(f"w{i}" for i in range(13)), "x"), (12, "É K 1", "x"),
    ]
    docs = [
        (1, f"intro. {text.upper()}! outro", "x"), (2, None, "x"), (3, "", "x"), (4, "?!", "x"), (5, "a SHORT-item here", "x"),
        (6, "word " * 25000 + text, "x"), (None, text, "x"), (7, "again one again one", "x"), (7, "again one again one", "x"),
        (7, "nothing", "x"), (8, "é k 1 É K 1", "x"), (9, " ".join(f"w{i % 17}" for i in range(3, 16)), "x"),
    ]
    assert got(spark, docs, items) == brute(docs, items)
    clean = decontaminate.clean(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert clean.columns == ["doc_id", "text", "item_id"]
    assert sorted((r.doc_id, r.text) for r in clean.where("doc_id < 10").collect() if r.text is not None) == sorted(
        (i, t) for (i, t, _), row in zip(docs, [brute([d], items)[0] for d in docs]) if t is not None and i is not None and not row[4])


def test_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontaminate.common.blocks, "__defaults__", (60,))
    docs = [(i, " ".join(f"w{(i * j) % 23}" for j in range(60)), "x") for i in range(20)]
    items = [(i, " ".join(f"w{(i * j) % 23}" for j in range(10, 30)), "x") for i in range(12)]
    assert got(spark, docs, items) == brute(docs, items)


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    docs = [(1, item, "x"), (2, item.replace("beta", "beta extra"), "x"), (3, "alpha nu", "x")]
    found = decontaminate.matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, item, "x")], ITEMS)).collect()
    assert {(r.doc_id, r.kind) for r in found} == {(1, "exact"), (2, "near")}


def test_empty_tables(spark):
    one = [(1, "some words here", "x")]
    assert got(spark, [], one) == []
    df = decontaminate.report(spark.createDataFrame(one, DOCS), spark.createDataFrame([], ITEMS))
    assert tuple(df.select("n_words", "n_hit", "contaminated").first()) == (3, 0, False)
