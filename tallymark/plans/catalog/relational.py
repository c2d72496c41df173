"""Projection, filters, grouped totals, list joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.labels import row_total as total_of
from tallymark.operators import ordered, relate, shape, totals
from tallymark.sources.readers import table

# In these queries suppliers play the countries, ship years the games' years,
# return flags the sports, and quantity + discount + tax the three medal counts.
_UNITS = ("l_quantity", "l_discount", "l_tax")
_UNITS_SQL = "round(sum(l_quantity + l_discount + l_tax), 2) AS total"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn(
        "ship_year", F.year("l_shipdate").cast("int")
    )


def _unit_sums(df: DataFrame, *keys: str) -> DataFrame:
    sums = totals.sum_by(df, keys, total_of(_UNITS), "total")
    return sums.withColumn("total", F.round("total", 2))


def sum_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unit_sums(_lines(spark, sf_dir), "l_suppkey")


def sum_by_key_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = shape.equal_to(_lines(spark, sf_dir), "l_returnflag", "R")
    return _unit_sums(returned, "l_suppkey")


def sum_by_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unit_sums(_lines(spark, sf_dir), "l_suppkey", "ship_year")


def entity_sum_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = shape.equal_to(_lines(spark, sf_dir), "l_suppkey", 1)
    return _unit_sums(one, "ship_year")


def distinct_entities_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = shape.equal_to(table(spark, sf_dir, "orders"), "o_orderstatus", "F")
    year = F.year("o_orderdate").cast("int").alias("order_year")
    return totals.distinct_of(filled, [year, F.col("o_custkey")])


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.distinct_of(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


def row_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").withColumn("p_size", F.nullif(F.col("p_size"), F.lit(7)))
    total = total_of(["p_size", "p_retailprice"])
    return parts.select("p_partkey", F.round(total, 2).alias("total"))


def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.with_label(
        table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderkey", "o_custkey", "o_totalprice"]
    )


def target_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    return shape.target_last(orders, "o_orderstatus")


def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = shape.renamed(
        table(spark, sf_dir, "customer"), {"c_custkey": "customer", "c_mktsegment": "segment"}
    )
    return shape.renamed_by_position(customers, {1: "name", 2: "nation", 3: "balance"})


def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").drop("o_orderdate", "o_orderpriority")


def filter_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = shape.equal_to(table(spark, sf_dir, "orders"), "o_orderstatus", "F")
    return filled.select("o_orderkey", "o_custkey", "o_totalprice")


def filter_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    solvent = shape.greater_than(table(spark, sf_dir, "customer"), "c_acctbal", 0)
    return solvent.select("c_custkey", "c_acctbal")


# Id lists: orders with a returned line (A) and orders with an open line (B).
def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two unrelated id columns side by side, NULL where a row adds no id."""
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")).alias("test_a"),
        F.when(F.col("l_linestatus") == "O", F.col("l_orderkey")).alias("test_b"),
    )


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")


def left_join_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = relate.id_list(_lists(spark, sf_dir), "test_a", "test_a")
    return relate.mark_in_list(_ids(spark, sf_dir), "o_orderkey", listed, "test_a")


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.list_flags(_lists(spark, sf_dir), "test_a", "test_b", "o_orderkey")


def left_join_two_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.mark_in_lists(
        _ids(spark, sf_dir), "o_orderkey", _flags(spark, sf_dir), "test_a", "test_b"
    )


def left_join_either_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = totals.distinct_of(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])
    parts = table(spark, sf_dir, "part").select("p_partkey")
    return relate.left_join_either_key(parts, "p_partkey", pairs, "l_partkey", "l_suppkey")


def inner_join_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.in_both_lists(_ids(spark, sf_dir), "o_orderkey", _flags(spark, sf_dir))


def membership_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = relate.with_membership(_ids(spark, sf_dir), "o_orderkey", _flags(spark, sf_dir))
    both = F.when(F.col("test_results") == 1, 1).otherwise(2)
    return coded.select("o_orderkey", "test_results", both.alias("both_or_not"))


def membership_code_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reading in which a row counts only when it is on both lists."""
    flags = _flags(spark, sf_dir)
    coded = relate.with_membership(_ids(spark, sf_dir), "o_orderkey", flags, one_sided=2)
    return coded.select("o_orderkey", "test_results")


def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = totals.class_shares(table(spark, sf_dir, "events"), "event_type")
    return shares.withColumn("share", F.round("share", 6))


def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.table_shape(table(spark, sf_dir, "orders"))


def num_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.class_count(table(spark, sf_dir, "embeddings"), "label")


def global_mean_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    with_mean = totals.with_global_mean(orders, "o_totalprice", "mean_price")
    return with_mean.withColumn("mean_price", F.round("mean_price", 4))


def top_n_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ordered.first_rows(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 100)


QUERIES = {
    "sum_by_key": sum_by_key,
    "sum_by_key_filtered": sum_by_key_filtered,
    "sum_by_two_keys": sum_by_two_keys,
    "entity_sum_by_period": entity_sum_by_period,
    "distinct_entities_by_period": distinct_entities_by_period,
    "distinct_rows": distinct_rows,
    "row_total": row_total,
    "project_columns": project_columns,
    "target_last": target_last,
    "rename_columns": rename_columns,
    "drop_columns": drop_columns,
    "filter_equals": filter_equals,
    "filter_positive": filter_positive,
    "left_join_list": left_join_list,
    "left_join_two_lists": left_join_two_lists,
    "left_join_either_key": left_join_either_key,
    "inner_join_lists": inner_join_lists,
    "membership_code": membership_code,
    "membership_code_strict": membership_code_strict,
    "class_distribution": class_distribution,
    "table_shape": table_shape,
    "num_classes": num_classes,
    "global_mean_column": global_mean_column,
    "top_n_rows": top_n_rows,
}

_LIST_A = "SELECT DISTINCT l_orderkey AS test_a FROM lineitem WHERE l_returnflag = 'R'"
_LIST_B = "SELECT DISTINCT l_orderkey AS test_b FROM lineitem WHERE l_linestatus = 'O'"
_YEAR = "CAST(year(l_shipdate) AS INTEGER)"

ORACLES = {
    "sum_by_key": f"SELECT l_suppkey, {_UNITS_SQL} FROM lineitem GROUP BY l_suppkey",
    "sum_by_key_filtered": f"""
        SELECT l_suppkey, {_UNITS_SQL} FROM lineitem
        WHERE l_returnflag = 'R' GROUP BY l_suppkey""",
    "sum_by_two_keys": f"""
        SELECT l_suppkey, {_YEAR} AS ship_year, {_UNITS_SQL}
        FROM lineitem GROUP BY ALL""",
    "entity_sum_by_period": f"""
        SELECT {_YEAR} AS ship_year, {_UNITS_SQL}
        FROM lineitem WHERE l_suppkey = 1 GROUP BY ALL""",
    "distinct_entities_by_period": """
        SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_custkey
        FROM orders WHERE o_orderstatus = 'F'""",
    "distinct_rows": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
    "row_total": """
        SELECT p_partkey, round(coalesce(nullif(p_size, 7), 0) + p_retailprice, 2) AS total
        FROM part""",
    "project_columns": """
        SELECT o_orderkey, o_custkey, o_totalprice, o_totalprice AS label FROM orders""",
    "target_last": """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderstatus FROM orders""",
    "rename_columns": """
        SELECT c_custkey AS customer, c_name AS name, c_nationkey AS nation,
               c_acctbal AS balance, c_mktsegment AS segment
        FROM customer""",
    "drop_columns": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "filter_equals": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""",
    "filter_positive": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0",
    "left_join_list": f"""
        SELECT o_orderkey, o_totalprice, test_a
        FROM orders LEFT JOIN ({_LIST_A}) a ON o_orderkey = test_a""",
    "left_join_two_lists": f"""
        SELECT o_orderkey, o_totalprice, test_a, test_b
        FROM orders LEFT JOIN ({_LIST_A}) a ON o_orderkey = test_a
        LEFT JOIN ({_LIST_B}) b ON o_orderkey = test_b""",
    "left_join_either_key": """
        SELECT p_partkey, l_partkey, l_suppkey
        FROM part LEFT JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) x
        ON l_partkey = p_partkey OR l_suppkey = p_partkey""",
    "inner_join_lists": f"""
        SELECT o_orderkey, o_totalprice FROM orders
        JOIN ({_LIST_A}) a ON o_orderkey = test_a JOIN ({_LIST_B}) b ON o_orderkey = test_b""",
    "membership_code": f"""
        SELECT o_orderkey,
               CASE WHEN test_a IS NOT NULL AND test_b IS NOT NULL THEN 1
                    WHEN test_a IS NULL AND test_b IS NULL THEN 2 ELSE 3 END AS test_results,
               CASE WHEN test_a IS NOT NULL AND test_b IS NOT NULL THEN 1 ELSE 2 END AS both_or_not
        FROM orders LEFT JOIN ({_LIST_A}) a ON o_orderkey = test_a
        LEFT JOIN ({_LIST_B}) b ON o_orderkey = test_b""",
    "membership_code_strict": f"""
        SELECT o_orderkey,
               CASE WHEN test_a IS NOT NULL AND test_b IS NOT NULL THEN 1 ELSE 2 END AS test_results
        FROM orders LEFT JOIN ({_LIST_A}) a ON o_orderkey = test_a
        LEFT JOIN ({_LIST_B}) b ON o_orderkey = test_b""",
    "class_distribution": """
        SELECT event_type, count(*) AS count, (SELECT count(*) FROM events) AS total,
               round(count(*) / (SELECT count(*) FROM events), 6) AS share
        FROM events GROUP BY event_type""",
    "table_shape": """
        SELECT count(*) AS n_rows, CAST(6 AS INTEGER) AS n_columns FROM orders""",
    "num_classes": "SELECT CAST(max(label) + 1 AS INTEGER) AS n_classes FROM embeddings",
    "global_mean_column": """
        SELECT o_orderkey, o_totalprice,
               round((SELECT avg(o_totalprice) FROM orders), 4) AS mean_price
        FROM orders""",
    "top_n_rows": """
        SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
}
