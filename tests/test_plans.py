"""What the physical plans must and must not contain."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tallymark.operators import encode, relate
from tallymark.plans.catalog import QUERIES, cleaning, encoding, evaluation, relational

FOLDER = "/root/testdata/sf0.001"
PLAIN = [k for m in (relational, cleaning, encoding, evaluation) for k in m.QUERIES]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", text))


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("key", PLAIN)
def test_no_pair_joins_and_no_python(spark, key):
    text = plan(QUERIES[key](spark, FOLDER))
    for bad in ("NestedLoopJoin", "CartesianProduct", "EvalPython", "InPandas", "MapInArrow"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["sum_by_key_filtered"](spark, FOLDER))
    assert "EqualTo(l_returnflag,R)" in text
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {f.split(":")[0] for f in read.split(",")} == {
        "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag",
    }


@pytest.mark.parametrize("key", ["sum_by_key", "sum_by_two_keys", "distinct_rows", "confusion_matrix"])
def test_grouping_is_one_shuffle_of_partial_results(spark, key):
    text = plan(QUERIES[key](spark, FOLDER))
    assert exchanges(text) == 1 and text.count("HashAggregate") == 2


@pytest.mark.parametrize(
    "key",
    ["global_mean_column", "mean_impute", "split_fraction", "fill_zero", "one_hot", "argmax_label"],
)
def test_rows_stay_where_they_are(spark, key):
    text = plan(QUERIES[key](spark, FOLDER))
    assert "Exchange hashpartitioning" not in text and "Window" not in text and "Sort " not in text


def test_both_lists_take_one_shuffle_and_the_ids_another(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(QUERIES["left_join_two_lists"](spark, FOLDER))
    assert exchanges(text) == 2 and "SortMergeJoin" in text


def skewed(spark):
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


def final_plan(df):
    df.collect()
    return plan(df)


def test_a_hot_value_is_split_when_levels_are_applied(spark):
    words = spark.range(0, 200_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 5000)).alias("t"),
    )
    levels = encode.level_index(words, "t")
    with skewed(spark):
        out = encode.apply_levels(words, "t", levels, "i").select("id", "t", "i")
        assert "skew=true" in final_plan(out)
    assert out.where("i is null").count() == 0


def test_a_hot_key_is_split_in_the_either_key_join(spark):
    ids = spark.range(6000).select(F.col("id").cast("int").alias("ID"))
    pairs = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") % 5000).cast("int")).alias("a"),
        ((F.col("id") * 7) % 5000).cast("int").alias("b"),
    )
    with skewed(spark):
        out = relate.left_join_either_key(ids, "ID", pairs, "a", "b")
        assert "skew=true" in final_plan(out)
    assert out.where("a is null").count() == 1000
