"""Running sums, quantiles, modes, null profile, imputation."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.operators import impute, ordered, profile, totals


@pytest.mark.parametrize("partitions", [1, 17])
def test_running_sums_match_a_plain_loop(spark, partitions):
    points = [(i * 7 % 1000, i % 13) for i in range(1000)]
    df = spark.createDataFrame(points, "k int, n int").repartition(partitions)
    out = ordered.running_sums(df, [F.desc("k")], {"t": F.col("n")}).collect()
    total, expected = 0, {}
    for k, n in sorted(points, reverse=True):
        total += n
        expected[k] = total
    assert {r.k: r.t for r in out} == expected
    assert {r.t_all for r in out} == {total}


def test_running_sums_restart_per_group(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 6), ("b", 1, 7)], "g string, k int, n int")
    out = ordered.running_sums(df, [F.col("k")], {"t": F.col("n")}, group="g").collect()
    assert sorted((r.g, r.k, r.t, r.t_all) for r in out) == [
        ("a", 1, 5, 11), ("a", 2, 11, 11), ("b", 1, 7, 7),
    ]


def test_ranked_counts_from_zero(spark):
    df = spark.range(500).select((F.col("id") * 3).alias("v"))
    out = ordered.ranked(df, [F.desc("v")]).collect()
    assert {r.v: r["rank"] for r in out} == {3 * i: 499 - i for i in range(500)}


@pytest.mark.parametrize("partitions", [1, 17])
def test_quantiles_are_exact_under_skew_and_missing(spark, partitions):
    draw = random.Random(11)
    a = [42.0 if draw.random() < 0.34 else draw.gauss(0, 100) for _ in range(3000)]
    b = [None if draw.random() < 0.5 else float(draw.randrange(5)) for _ in range(3000)]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double").repartition(partitions)
    wanted = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    out = {
        (r.column, r.probability): r.value
        for r in profile.quantiles(df, ["a", "b"], wanted).collect()
    }
    for name, values in (("a", a), ("b", [v for v in b if v is not None])):
        for p in wanted:
            assert out[name, p] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_quantiles_beyond_the_sketch(spark):
    # Enough distinct values that most rows fall outside the brackets.
    df = spark.range(200_000, numPartitions=8).select(
        ((F.col("id") * 7919) % 200_003).cast("double").alias("v")
    )
    values = np.array([i * 7919 % 200_003 for i in range(200_000)], dtype=float)
    for row in profile.quantiles(df, ["v"], [0.01, 0.5, 0.501, 0.99]).collect():
        assert row.value == pytest.approx(np.quantile(values, row.probability), abs=1e-6)


def test_quantiles_leave_out_nan_and_skip_empty_columns(spark):
    df = spark.createDataFrame(
        [(1.0, None), (float("nan"), None), (3.0, None)], "a double, b double"
    )
    out = profile.quantiles(df, ["a", "b"], [0.5]).collect()
    assert [tuple(r) for r in out] == [("a", 0.5, 2.0)]


def test_modes_break_ties_by_the_columns_own_order(spark):
    df = spark.createDataFrame(
        [(10, "b"), (9, "a"), (10, "b"), (9, "a"), (3, None)], "n int, t string"
    )
    assert dict(profile.modes(df, ["n", "t"]).collect()) == {"n": "9", "t": "a"}
    assert impute.modes(df, ["n", "t"]).dtypes == [("n", "int"), ("t", "string")]


def test_missing_profile_counts_nulls_and_words(spark):
    df = spark.createDataFrame([(1, "NA"), (None, " "), (3, None), (4, "x")], "n int, t string")
    plain = {r.column: (r.n_missing, r.pct) for r in profile.missing_profile(df).collect()}
    assert plain == {"n": (1, 25.0), "t": (1, 25.0)}
    words = profile.missing_profile(df, ("", "NA")).collect()
    assert {r.column: r.n_missing for r in words} == {"n": 1, "t": 3}


def test_missing_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "n int, t string")
    assert [tuple(r) for r in profile.missing_profile(df).collect()] == [
        ("n", 0, None), ("t", 0, None),
    ]


def test_imputation(spark):
    train = spark.createDataFrame(
        [(1.0, "x", 1), (2.0, "x", None), (9.0, "y", 5), (None, None, 5)], "a double, t string, n int"
    )
    test = spark.createDataFrame([(None, None, None)], "a double, t string, n int")
    for statistic, expected in (
        (impute.means(train, ["a"]), (4.0, None, None)),
        (impute.medians(train, ["a"]), (2.0, None, None)),
        (impute.medians(train, ["a"], accuracy=1000), (2.0, None, None)),
        (impute.modes(train, ["t", "n"]), (None, "x", 5)),
    ):
        assert tuple(impute.fill_from(test, statistic).first()) == expected
    assert tuple(impute.fill_numbers(test).first()) == (0.0, None, 0)
    assert tuple(impute.fill_text(test, "?").first()) == (None, "?", None)
    assert tuple(impute.fill_columns(test, {"a": "-1", "t": "-1"}).first()) == (-1.0, "-1", None)


def test_numeric_summary_of_one_value(spark):
    df = spark.createDataFrame([(2.0,), (None,)], "a double")
    row = profile.numeric_summary(df, ["a"]).first()
    assert (row["count"], row["mean"], row["stddev"], row["min"], row["max"]) == (
        1, 2.0, None, 2.0, 2.0,
    )


def test_class_shares_of_an_unbalanced_target(spark):
    target = [1] * 67 + [0] * 933
    df = spark.createDataFrame([(t,) for t in target], "Target int")
    out = {r.Target: (r["count"], r.total, r.share) for r in totals.class_shares(df, "Target").collect()}
    assert out == {k: (n, 1000, n / 1000) for k, n in Counter(target).items()}


def test_global_mean_and_top_rows(spark):
    df = spark.createDataFrame([(1, 4.0), (2, None), (3, 8.0)], "id int, v double")
    assert {r.m for r in totals.with_global_mean(df, "v", "m").collect()} == {6.0}
    top = ordered.first_rows(df, [F.desc_nulls_last("v"), F.asc("id")], 2)
    assert [r.id for r in top.collect()] == [3, 1]
