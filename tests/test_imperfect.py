"""Splits, quantiles, measures and sinks over tables with gaps and odd weights."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.operators import encode, evaluate, profile, split
from tallymark.sources import sinks


@pytest.fixture(scope="module")
def keyed(spark):
    missing = F.col("id") % 10 == 0
    return spark.range(1000).select(
        F.when(~missing, F.col("id")).alias("k"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 5).alias("a"),
        F.when(~missing, F.concat(F.lit("x"), F.col("id"))).alias("b"),
        F.col("id").alias("row"),
    ).cache()


@pytest.mark.parametrize("key", ["k", ["a", "b"]])
@pytest.mark.parametrize(
    "weights", [[1, 0], [0, 1], [0.7, 0.3, 0], [0, 0.7, 0, 0.3], [0.7, 0.3], [1, 1, 1], [5]]
)
def test_parts_are_disjoint_and_complete(keyed, key, weights):
    parts = [[r.row for r in p.select("row").collect()] for p in split.split(keyed, key, weights)]
    assert sorted(x for p in parts for x in p) == list(range(1000))
    for rows, weight in zip(parts, weights):
        assert weight > 0 or rows == []


def test_split_refuses_impossible_weights(keyed):
    for weights in ([0, 0], [1, -1]):
        with pytest.raises(ValueError):
            split.split(keyed, "k", weights)


def test_missing_keys_have_a_fold_and_parts_of_a_key_matter(keyed):
    folded = split.with_fold(keyed, "k", 5)
    assert folded.where("fold IS NULL OR fold NOT BETWEEN 0 AND 4").isEmpty()
    assert folded.where("k IS NULL").select("fold").distinct().count() == 1
    # (NULL, x) and (x, NULL) are different keys.
    pair = keyed.sparkSession.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    assert pair.select(split.draw(["a", "b"])).distinct().count() == 2


@pytest.mark.parametrize("partitions", [1, 60])
def test_quantiles_of_large_and_hostile_columns(spark, partitions):
    n = 60_000
    i = F.col("id")
    df = spark.range(n, numPartitions=partitions).select(
        ((i * 7919) % 60_013).cast("double").alias("spread"),
        F.when(i % 3 == 0, 5.0).otherwise(i / 7.0).alias("hot"),
        F.when(i == 0, 1e300).when(i == 1, -1e300).otherwise(i % 1000 / 3.0).alias("outliers"),
        F.when(i < 30, float("inf")).when(i < 60, float("-inf")).otherwise(F.sin(i.cast("double"))).alias("infinite"),
        F.lit(4.0).alias("constant"),
        F.when(i % 2 == 0, i.cast("double")).alias("half"),
    )
    wanted = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9999, 1.0]
    got = {(r.column, r.probability): r.value for r in profile.quantiles(df, df.columns, wanted).collect()}
    for name, values in df.toPandas().items():
        ordered = np.sort(values.dropna().to_numpy())
        for p in wanted:
            rank = (len(ordered) - 1) * p
            low, high = ordered[math.floor(rank)], ordered[math.ceil(rank)]
            expected = low if low == high else low + (rank - math.floor(rank)) * (high - low)
            assert got[name, p] == pytest.approx(expected, rel=1e-12, abs=1e-12)


def test_measures_of_regressions_with_gaps(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (3.0, 3.0), (100.0, None), (None, 7.0)], "label double, prediction double"
    )
    assert evaluate.r_squared(df, "label", "prediction").first().r2 == 1.0
    assert tuple(evaluate.unpredicted(df, "label", "prediction").first()) == (1, 1)
    level = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "label double, prediction double")
    assert evaluate.r_squared(level, "label", "prediction").first().r2 is None


def test_measures_of_classes_with_gaps(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (1.0, None), (0.0, 9.0), (None, 1.0)], "label double, prediction double"
    )
    row = evaluate.accuracy(df, "label", "prediction").first()
    assert row.accuracy == pytest.approx(1 / 3) and row.test_error == pytest.approx(2 / 3)
    wide = {r[0]: tuple(r[1:]) for r in evaluate.confusion_table(df, "label", "prediction", [0.0, 1.0]).collect()}
    assert wide == {1.0: (0, 1, 1), 0.0: (0, 0, 1), None: (0, 1, 0)}


def test_curves_with_gaps_and_one_class(spark):
    rows = [(1.0, 0.9), (0.0, 0.4), (1.0, 0.3), (None, 0.5), (1.0, None), (0.0, 0.1)]
    points = evaluate.operating_points(spark.createDataFrame(rows, "label double, score double"), "label", "score")
    assert points.count() == 4 and evaluate.auc(points).first().auc == 0.75
    assert evaluate.pr_curve(points).count() == 5
    assert evaluate.precision_recall_by_threshold(points).where("precision IS NULL").isEmpty()
    one = spark.createDataFrame([(1.0, 0.9), (1.0, 0.2)], "label double, score double")
    assert evaluate.auc(evaluate.operating_points(one, "label", "score")).first().auc is None


def test_probabilities_and_missing_predictions_are_written(spark):
    df = spark.createDataFrame(
        [(1, 1.0, [0.2, 0.8]), (2, None, None)], "id int, prediction double, probability array<double>"
    )
    assert [r.y for r in sinks.submission(df, "id").collect()] == ["pass", None]
    flat = sinks.probability_columns(df, 2).orderBy("id")
    assert flat.columns == ["id", "prediction", "probability_0", "probability_1"]
    assert tuple(flat.first()) == (1, 1.0, 0.2, 0.8)


def test_missing_values_are_a_level_where_they_are_kept(spark):
    df = spark.createDataFrame([("yes", "a"), (None, "a"), ("yes", "a")], "answer string, constant string")
    assert encode.usable_categories(df, ["answer", "constant"], keep_unseen=True) == ["answer"]
    assert encode.usable_categories(df, ["answer", "constant"]) == []
    model = encode.fit_features(df, ["answer", "constant"], [], keep_unseen=True)
    assert encode.slot_count(model.transform(df)) == 1
