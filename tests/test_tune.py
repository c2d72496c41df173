"""Cross validation, stratified splits, permutation importance."""

import math

import pytest
from pyspark.sql import functions as F

from tallymark.operators import encode, explain, split, train, tune


@pytest.fixture(scope="module")
def noisy(spark):
    rows = spark.range(600).select(
        "id",
        ((F.col("id") * 37) % 101 / 101.0).alias("a"),
        ((F.col("id") * 53) % 97 / 97.0).alias("b"),
        F.concat(F.lit("kind"), F.col("id") % 3).alias("kind"),
    )
    label = ((F.col("a") + F.col("b") > 1) & (F.col("id") % 10 != 0)).cast("double")
    return rows.withColumn("label", label)


def features(df):
    model = encode.fit_features(df, ["kind"], ["a", "b"])
    return model.transform(df).select("id", "label", "features")


def test_folds_stay_beside_the_grid(noisy):
    rows = features(noisy)
    choices = {"maxDepth": [1, 4], "impurity": ["gini", "entropy"]}
    found = tune.validate(rows, "id", train.estimator("tree", seed=1), choices, folds=4)
    folds = found.folds.collect()
    grid = {r.params: r for r in found.grid.collect()}
    assert len(folds) == 16 and len(grid) == 4 and sum(r.best for r in grid.values()) == 1
    for params, row in grid.items():
        own = [r for r in folds if r.params == params]
        assert sum(r.n for r in own) == 600
        assert row.measure == pytest.approx(sum(r.measure for r in own) / 4)
    best = max(r.measure for r in grid.values())
    assert next(r for r in grid.values() if r.best).measure == best
    assert found.model.getOrDefault("maxDepth") == found.best["maxDepth"]


def test_every_row_is_scored_by_a_model_that_has_not_seen_it(noisy):
    found = tune.validate(features(noisy), "id", train.estimator("logistic"), {"regParam": [0.01], "threshold": [0.3, 0.5]}, folds=3)
    apart = tune.held_out(found, ["id", "label"])
    assert apart.count() == 600 == apart.select("id").distinct().count()
    threshold = found.best["threshold"]
    for fold in range(3):
        seen = found.rows.where(F.col("fold") != fold)
        again = train.estimator("logistic", regParam=0.01, threshold=threshold).fit(seen)
        rows = again.transform(found.rows.where(F.col("fold") == fold)).select("id", "prediction")
        assert sorted(map(tuple, rows.collect())) == sorted(
            (r.id, r.prediction) for r in apart.where(F.col("fold") == fold).collect())
    right = apart.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    weighted = found.folds.join(found.grid.where("best"), "params").agg(
        F.sum(F.col("n") * found.folds["measure"]) / F.sum("n")).first()[0]
    assert right == pytest.approx(weighted)


def test_report_measures_both_parts(noisy):
    learn, test = split.split(noisy, "id", [0.7, 0.3])
    model = encode.fit_features(learn, ["kind"], ["a", "b"])
    rows, others = (model.transform(x).select("id", "label", "features") for x in (learn, test))
    found = tune.validate(rows, "id", train.estimator("tree", maxDepth=5, seed=1), {"minInstancesPerNode": [1, 30]}, folds=3)
    parts = {r.part: r for r in tune.report(found, others).collect()}
    assert parts["train"].n == rows.count() and parts["test"].n == others.count()
    again = found.model.transform(others).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert parts["test"].measure == again


def test_another_measure_and_ties(noisy):
    rows = features(noisy.withColumn("label", F.col("a") * 2))
    found = tune.validate(rows, "id", train.estimator("linear"), {"regParam": [0.5, 0.0, 0.0]}, tune.root_mean_square, folds=3)
    grid = found.grid.collect()
    assert [r.best for r in grid] == [False, True, False] and abs(grid[1].measure) < 1e-6 < -grid[0].measure


def test_too_few_rows(noisy):
    rows = features(noisy).limit(1)
    with pytest.raises(ValueError, match="two folds"):
        tune.validate(rows, "id", train.estimator("tree"), {"maxDepth": [1]})


# Stratified splits -------------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 9])
def test_shares_are_exact(spark, partitions):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 700, F.concat(F.lit("c"), F.col("id") % 7)).alias("label"))
    parts = split.split_stratified(df.repartition(partitions), "id", "label", [0.8, 0.2])
    assert sum(p.count() for p in parts) == 1000 == parts[0].unionAll(parts[1]).distinct().count()
    sizes = {r.label: r["count"] for r in df.groupBy("label").count().collect()}
    first = {r.label: r["count"] for r in parts[0].groupBy("label").count().collect()}
    assert first == {label: math.floor(0.8 * n + 0.5) for label, n in sizes.items()}
    again = split.split_stratified(df.repartition(4), "id", "label", [0.8, 0.2])[0]
    assert sorted(r.id for r in again.collect()) == sorted(r.id for r in parts[0].collect())
    assert parts[0].columns == ["id", "label"]


def test_odd_keys_and_clashing_names(spark):
    rows = [(None, "x", 1, i) for i in range(10)] + [(1, "x", 1, 5)] * 10 + [(2, None, 2, 0)]
    df = spark.createDataFrame(rows, "key long, class string, rank int, draw int")
    parted = split.with_stratified_part(df, "key", "class", [1, 1], name="row")
    assert parted.columns == [*df.columns, "row"] and parted.count() == 21
    assert {(r["class"], r.row): r.n for r in parted.groupBy("class", "row").agg(F.count("*").alias("n")).collect()} == {
        ("x", 0): 10, ("x", 1): 10, (None, 0): 1}
    assert split.with_stratified_part(df.limit(0), "key", "class", [1, 1]).count() == 0
    with pytest.raises(ValueError):
        split.with_stratified_part(df, "key", "class", [0, 0])


# Importance ---------------------------------------------------------------------


def test_shuffle_keeps_values_and_moves_rows(noisy):
    mixed = explain.shuffled(noisy, "id", ["a", "kind"])
    rows = mixed.collect()
    assert len(rows) == 600
    assert sorted(r.a for r in rows) == sorted(r.a__shuffled for r in rows)
    assert sorted(r.kind for r in rows) == sorted(r.kind__shuffled for r in rows)
    assert sum(r.a == r.a__shuffled for r in rows) < 40
    again = explain.shuffled(noisy.repartition(5), "id", ["a", "kind"])
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))


def test_importance_of_used_and_unused_columns(noisy):
    sure = noisy.withColumn("label", (F.col("kind") == "kind1").cast("double"))
    model = train.fit(sure, encode.feature_stages(["kind"], ["a", "b"]), train.estimator("tree", seed=1))
    found = {r.feature: r for r in explain.permutation_importance(model.transform, sure, "id", ["a", "b", "kind"]).collect()}
    assert found[None].measure == 1 and found["a"].loss == found["b"].loss == 0
    assert 0.3 < found["kind"].loss < 0.6
    alone = explain.permutation_importance(model.transform, sure.limit(1), "id", ["kind"]).collect()
    assert [r.loss for r in alone] == [0.0, 0.0]


def test_outcomes_of_the_importance_query_are_made_once(spark, monkeypatch, tmp_path):
    from tallymark.plans.catalog import selection

    made = spark.sparkContext.accumulator(0)

    def seen(i):
        made.add(1)
        return i

    def rows(spark, sf_dir):
        id_ = F.udf(seen, "long")("id")
        return spark.range(40).select(
            id_.alias("o_orderkey"), F.lit("p").alias("o_orderpriority"), F.when(F.col("id") % 3 > 0, "F").otherwise("O").alias("o_orderstatus"),
            F.lit(1.0).alias("o_totalprice"), *[(F.col("id") % i).cast("double").alias(n) for i, n in enumerate(
                ("n_lines", "quantity", "discount", "tax"), 3)],
            (F.col("id") % 2).cast("double").alias("n_returned"), (F.col("id") % 2).cast("double").alias("label"))

    monkeypatch.setattr(selection, "outcome_rows", rows)
    losses = {r.feature: r.loss for r in selection.permutation_importance(spark, str(tmp_path)).collect()}
    assert made.value == 40
    assert losses.pop("n_returned") > 0 and set(losses.values()) == {0.0}
