"""The complete jobs on small files made here."""

import random

from pyspark.sql import functions as F

from tallymark.operators import encode, evaluate, split, train
from tallymark.plans import distress, engine_tests, hazard, medals, sales
from tallymark.sources import readers, schemas
from tallymark.streaming.scoring import score_stream


def write(path, rows, header=None):
    lines = [",".join(header)] if header else []
    lines += [",".join("" if v is None else str(v) for v in row) for row in rows]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_medal_tallies(spark, tmp_path):
    rows = [
        ("Ann", 20, "India", 2000, "d", "Hockey", 1, 0, 0, 1),
        ("Ann", 24, "India", 2004, "d", "Hockey", 0, 1, 0, 1),
        ("Ann", 24, "India", 2004, "d", "Chess", 0, 1, 1, 2),
        ("Bob", 30, "Spain", 2000, "d", "Hockey", None, 0, 2, 2),
        ("Cid", 31, "Spain", 2000, "d", "Golf", 0, 0, 0, 0),
        ("Dot", 31, "Malta", 2000, "d", "Golf", 0, 0, 0, 0),
    ]
    source = write(tmp_path / "medals.csv", rows)
    medals.run(spark, source, str(tmp_path / "out"))

    def read(name):
        df = readers.csv(spark, str(tmp_path / "out" / name))
        return df.columns, sorted(map(tuple, df.collect()))

    assert read("country_in_sport") == (["country", "medals"], [("India", 2), ("Spain", 2)])
    assert read("one_country_by_games")[1] == [("India", 2000, 1), ("India", 2004, 3)]
    assert read("country")[1] == [("India", 4), ("Malta", 0), ("Spain", 2)]
    assert read("country_by_games") == (
        ["country", "olympic_year", "medals"],
        [("India", 2000, 1), ("India", 2004, 3), ("Malta", 2000, 0), ("Spain", 2000, 2)],
    )
    assert read("athletes_by_games")[1] == [(2000, "Ann"), (2004, "Ann")]


def test_distress_profile_and_imputation(spark, tmp_path):
    draw = random.Random(2)
    rows = [
        (int(i % 15 == 0), draw.random(), 20 + i % 50, i % 3, draw.random(),
         "NA" if i % 5 == 0 else 1000 + i, 1, 2, 3, 4, "NA" if i % 7 == 0 else i % 2)
        for i in range(150)
    ]
    source = write(tmp_path / "f.csv", rows)
    distress.run(spark, source, str(tmp_path / "out"))
    shares = {r.Target: r["count"] for r in readers.csv(spark, str(tmp_path / "out/class_shares")).collect()}
    assert shares == {1: 10, 0: 140}
    missing = {r.column: r.n_missing for r in readers.csv(spark, str(tmp_path / "out/missing")).collect()}
    assert missing["Monthly_Income"] == 30 and missing["NumberOfDependents"] == 22
    done = spark.read.parquet(str(tmp_path / "out/prepared"))
    assert done.columns[-2:] == ["Target", "avg_util"]
    assert done.na.drop().count() == 150
    known = [1000 + i for i in range(150) if i % 5]
    filled = done.where(~F.col("Monthly_Income").isin(known))
    assert {round(r.Monthly_Income, 6) for r in filled.collect()} == {round(sum(known) / len(known), 6)}


def test_sales_models(spark, tmp_path):
    draw = random.Random(4)
    rows = []
    for store in range(6):
        for day in range(40):
            promo = draw.randrange(2)
            amount = 0 if day % 9 == 0 else 100 + 50 * promo + 10 * (day % 7) + draw.gauss(0, 1)
            rows.append(
                (store, "abc"[store % 3], "xy"[store % 2], f"2015-{1 + day // 28:02d}-{1 + day % 28:02d}",
                 "" if day % 11 == 0 else 500 * store, 3, 1 + day % 7, 1 + day // 28, 2015, amount,
                 20, 1, promo, "" if day == 5 else "n", "yn"[day % 2], "n", day % 2, 1, 2, 3, 4, 5)
            )
    source = write(tmp_path / "s.csv", rows)
    table = sales.cleaned(readers.csv(spark, source, schemas.SALES, header=False))
    assert table.count() == sum(1 for r in rows if r[9] > 0 and r[13])
    assert table.where("competitor_distance is null").count() == 0
    sales.run(spark, source, str(tmp_path / "out"))
    for name in ("short", "long"):
        r2 = readers.csv(spark, str(tmp_path / "out" / name / "r_squared")).first()[0]
        assert r2 > 0.9


def engine_row(draw, i, with_label):
    good = draw.random() < 0.5
    words = [draw.choice(["a b", " NA ", "", "c"]) for _ in range(18)]
    turbo = "yes" if good else "no"
    row = [i] + (["pass" if good else "fail"] if with_label else [])
    return row + [draw.choice(["4", " 6", "NA", "NULL", ""]), turbo, *words]


def test_engine_tests_end_to_end(spark, tmp_path):
    draw = random.Random(6)
    names = [f.name for f in schemas.ENGINE_TESTS]
    known = write(tmp_path / "train.csv", [engine_row(draw, i, True) for i in range(200)], names)
    new = write(
        tmp_path / "test.csv", [engine_row(draw, 1000 + i, False) for i in range(60)],
        [n for n in names if n != "y"],
    )
    lists = write(
        tmp_path / "a.csv",
        [(i if i % 3 else None, i if i % 2 else None) for i in range(190)],
        ["TestA", "TestB"],
    )
    new_lists = write(tmp_path / "b.csv", [(1000 + i, 1000 + i) for i in range(50)], ["TestA", "TestB"])
    small = {
        "forest": ({"seed": 1}, {"numTrees": [4], "maxDepth": [3, 5]}),
        "logistic": ({"maxIter": 5}, {"regParam": [0.1, 0.01]}),
    }
    out = str(tmp_path / "out")
    engine_tests.run(spark, known, lists, new, new_lists, out, small, folds=2)

    prepared = spark.read.parquet(f"{out}/train")
    assert prepared.count() == 200 and prepared.na.drop().count() == 200
    expected = {1: 0, 2: 0, 3: 0}
    for i in range(200):
        a, b = i < 190 and i % 3 != 0, i < 190 and i % 2 != 0
        expected[1 if a and b else 3 if a or b else 2] += 1
    assert dict(prepared.groupBy("test_results").count().collect()) == expected
    assert prepared.where("Lubrication like '% %' or Lubrication in ('', 'NA')").count() == 0
    answer = readers.csv(spark, f"{out}/submission", schemas.SUBMISSION)
    assert answer.count() == 60 and {r.y for r in answer.collect()} <= {"pass", "fail"}
    assert readers.csv(spark, f"{out}/forest/grid").count() == 2
    assert readers.csv(spark, f"{out}/forest/accuracy").first().accuracy > 0.8

    # The indexed variant, its curves, the network, and streaming with the saved model.
    learn, holdout = split.split(prepared, "ID", [0.8, 0.2])
    features = encode.fit_features(learn, ["material_grade"], engine_tests.NUMBERS, keep_unseen=True)
    ready = engine_tests.featured(learn, features)
    model = engine_tests.indexed_logistic(ready)
    assert {r.predicted_label for r in model.transform(ready).collect()} <= {"0.0", "1.0"}
    scored = train.score(model, engine_tests.featured(holdout, features), ["indexed_label"])
    found = engine_tests.curves(scored, "indexed_label")
    assert found["auc"].first().auc > 0.9 and found["best_threshold"].first().f_measure > 0.9
    network = engine_tests.perceptron(ready, hidden=[3], maxIter=5)
    assert 0 <= evaluate.accuracy(train.score(network, ready, ["label"]), "label", "prediction").first()[0] <= 1


def test_hazard_scores(spark, tmp_path):
    draw = random.Random(8)

    def row(i, known):
        word = draw.choice("pqr") if known else draw.choice("pqrs")
        return (i, *([1 + "pqr".index(word)] if known else []), draw.randrange(9), word)

    train_path = write(tmp_path / "tr.csv", [row(i, True) for i in range(120)], ["Id", "Hazard", "T1", "T2"])
    test_path = write(tmp_path / "te.csv", [row(500 + i, False) for i in range(30)], ["Id", "T1", "T2"])
    small = {"forest": {"numTrees": 3, "seed": 1}, "boosted": {"maxIter": 3, "seed": 1}}
    hazard.run(spark, train_path, test_path, str(tmp_path / "out"), **small)
    out = readers.csv(spark, str(tmp_path / "out/result"))
    assert out.columns == ["id", "Hazard"] and out.count() == 30 and out.na.drop().count() == 30


def test_streamed_scores_equal_batch_scores(spark, tmp_path):
    df = spark.range(100).select(
        F.col("id").cast("int").alias("ID"), (F.col("id") % 10).cast("double").alias("x"),
        (F.col("id") % 10 > 4).cast("double").alias("label"),
    )
    model = train.fit(df, encode.feature_stages([], ["x"]), train.estimator("tree", seed=1))
    source = str(tmp_path / "in")
    df.select("ID", "x").repartition(3).write.option("header", True).csv(source)
    query = score_stream(
        spark, model, source, df.select("ID", "x").schema, ["ID"],
        str(tmp_path / "out"), str(tmp_path / "progress"),
    )
    assert query.awaitTermination(120)
    streamed = {r.ID: r.prediction for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert streamed == {r.ID: r.prediction for r in train.score(model, df, ["ID"]).collect()}
