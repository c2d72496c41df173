import math
import random

import pytest
from pyspark.sql import functions as F

from tallymark.llm import common, toxicity


@pytest.fixture(scope="module")
def learned(spark):
    common.on_workers(spark)
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return docs, labels, held, toxicity.learned(docs, labels.where(~held))


def test_held_out_accuracy(learned):
    docs, labels, held, model = learned
    scored = toxicity.scored(docs, model)
    assert scored.count() == docs.count() and scored.where("score NOT BETWEEN 0 AND 1").isEmpty()
    rows = scored.join(labels, "doc_id").where(held).collect()
    toxic = [r.score >= 0.3 for r in rows if r.toxic == 1]
    clean = [r.score >= 0.3 for r in rows if r.toxic == 0]
    assert sum(toxic) >= 0.6 * len(toxic) and sum(clean) <= 0.05 * len(clean)


def test_folding():
    assert toxicity.folded("1d10t IDІОT i​diot ѕtupid!!") == " idiot idiot idiot stupid"
    assert toxicity.folded("$tup1d, m0r0n? |") == " stupid moron"
    assert toxicity.folded(None) == toxicity.folded("  \n") == toxicity.folded("!!!") == " "


def test_longest_entry_and_exceptions():
    model = toxicity.Toxicity({"clow": 1.0, "clown": 3.0, "clown fish": 0.0}, (0.0, 1.0, 0.0, 0.0))
    found = lambda t: toxicity.features(t, model.matcher())[1] * (len(t.split()) + 20) / 100
    assert found("a clown") == pytest.approx(3) and found("clow clowns") == pytest.approx(4)
    assert found("the clown fish") == pytest.approx(0) and found("acclown") == pytest.approx(0)
    assert found("clown clown") == pytest.approx(6)


def test_odd_rows(spark, learned):
    *_, model = learned
    rows = [(1, None, 0.5), (2, "", 0.5), (None, "word", 0.5), (3, "word " * 40000, 0.5), (4, "x", 0.5), (4, "x", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = toxicity.scored(docs, model).collect()
    assert len(got) == 6 and all(0 <= r.score < 0.3 for r in got)
    assert len({r.score for r in got if r.doc_id == 4}) == 1
    assert toxicity.scored(docs.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", 1)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, None)], "doc_id long, quality int, toxic int")
    model = toxicity.learned(docs, labels)
    assert model.weights == {} and toxicity.scored(docs, model).first().score < 0.01


def test_sample_bound_is_kept(spark, learned):
    docs, labels, *_ = learned
    rows = toxicity.labelled_sample(docs, labels, 20).groupBy("toxic").count().collect()
    assert all(0 < r["count"] <= 40 for r in rows)


def test_rare_telling_words_are_learned(spark):
    """A telling word among tens of thousands of commoner harmless ones gets a weight."""
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    plain = [" ".join(name(i) + "xxxxxx" for i in range(part, 9000, 2)) for part in (0, 1)]
    rows = [(i, plain[i % 2], i // 2 % 2) for i in range(80)]
    rows += [(100 + i, plain[i % 2] + " zquorf", 1) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learned(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert any(w > 0 and e.startswith("zquo") for e, w in model.weights.items())


def brute_model(rows, sample):
    """Weights again, from whole texts in plain Python."""
    texts, hits, words, sizes = {}, {}, {0: 0, 1: 0}, {0: 0, 1: 0}
    for text, label in sample:
        plain = toxicity.folded(text).split()
        words[label] += len(plain)
        sizes[label] += 1
        found = [w[:n] for w in plain for n in range(3, min(len(w), 10) + 1)]
        for entry in set(found):
            texts[entry, label] = texts.get((entry, label), 0) + 1
            hits[entry, label] = hits.get((entry, label), 0) + found.count(entry)
    weights = {}
    for entry in {e for e, _ in texts}:
        t = [texts.get((entry, x), 0) for x in (0, 1)]
        h = [hits.get((entry, x), 0) for x in (0, 1)]
        dense = ((h[1] + 0.5) / max(1, words[1])) / ((h[0] + 0.5) / max(1, words[0]))
        usual = ((t[1] + 0.5) / sizes[1]) / ((t[0] + 0.5) / sizes[0])
        if t[1] >= toxicity.MIN_TEXTS and math.sqrt(dense * usual) >= toxicity.MIN_LIFT and usual > 2:
            weights[entry] = (t[1], math.log(math.sqrt(dense * usual)))
    return {
        e: w for e, (t, w) in weights.items()
        if not any(o != e and o.startswith(e) and n >= 0.9 * t for o, (n, _) in weights.items())
    }


def brute_score(text, model):
    """The longest entry at every word start counts once; entries may span words."""
    plain = toxicity.folded(text)
    n = plain.count(" ") if len(plain) > 1 else 0
    total, at = 0.0, 0
    while at < len(plain):
        entries = [e for e in model.weights if plain.startswith(" " + e, at)]
        best = max(entries, key=len, default=None)
        if best is not None:
            total += model.weights[best]
        at += 1 + len(best) if best is not None else 1
    z = model.curve[0] + sum(
        a * b for a, b in zip(model.curve[1:], [math.log1p(total), 100 * total / (n + 20), total / math.sqrt(n + 20)]))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_weights_and_scores_by_brute_force(spark):
    rng = random.Random(2)
    plain = ["river", "rivet", "stone", "stones", "idea", "idiom", "letter", "lettuce", "clown fish", "moral", "l0ss"]
    bad = ["idiot", "1diot", "idiots", "losers", "MORON", "m0ronic", "clown"]
    rows = []
    for i in range(160):
        label = int(i % 4 == 0)
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        for _ in range(rng.randint(2, 9) if label else rng.random() < 0.05):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), label))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learned(docs, docs.select("doc_id", "toxic"))
    expected = brute_model(rows, [(t, x) for _, t, x in rows])
    learned = {e: w for e, w in model.weights.items() if w}
    assert learned.keys() == expected.keys() and len(learned) >= 3
    assert all(learned[e] == pytest.approx(expected[e]) for e in learned)
    for r in toxicity.scored(docs, model).collect():
        assert r.score == pytest.approx(brute_score(rows[r.doc_id][1], model))
