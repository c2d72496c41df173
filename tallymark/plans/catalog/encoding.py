"""Indexes, indicator slots and feature vectors."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import encode, sparse
from tallymark.sources.readers import table


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")


def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir).select("p_partkey", "p_type")
    return encode.fit_string_index(parts, "p_type", "type_index").transform(parts)


def string_index_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The same rule for a column with too many levels for the driver.
    names = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return encode.apply_levels(names, "c_name", encode.level_index(names, "c_name"), "name_index")


def string_index_alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    model = encode.fit_string_index(parts, "p_brand", "brand_index", alphabetical=True)
    return model.transform(parts)


def encode_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    levels = encode.level_index(parts, "p_brand", "first_seen", by="p_partkey")
    return encode.apply_levels(parts, "p_brand", levels, "brand_index")


def index_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    model = encode.fit_string_index(customers, "c_mktsegment", "segment_index")
    back = encode.labels_back(model, "segment_index", "segment_again")
    return back.transform(model.transform(customers))


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir).select("p_partkey", "p_type")
    model = encode.fit_features(parts, ["p_type"], [])
    return encode.vector_rows(model.transform(parts), "p_partkey", "p_type_vec")


def feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir)
    model = encode.fit_features(parts, ["p_type"], ["p_size", "p_retailprice"])
    return encode.vector_rows(model.transform(parts), "p_partkey", "features")


def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir).withColumn("one", F.lit(1.0))
    assembler = VectorAssembler(inputCols=["p_size", "p_retailprice", "one"], outputCol="raw")
    vectors = assembler.transform(parts).select("p_partkey", "raw")
    scaler = StandardScaler(inputCol="raw", outputCol="scaled", withStd=True, withMean=False)
    rows = encode.vector_rows(scaler.fit(vectors).transform(vectors), "p_partkey", "scaled")
    return rows.withColumn("value", F.round("value", 6))


def vector_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The status code has three values (-1, 0, 1), the price has many.
    code = F.when(F.col("o_orderstatus") == "F", -1).when(F.col("o_orderstatus") == "O", 0)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", code.otherwise(1).alias("code"), "o_totalprice"
    )
    assembler = VectorAssembler(inputCols=["code", "o_totalprice"], outputCol="features")
    vectors = assembler.transform(orders).select("o_orderkey", "features")
    model = encode.fit_slot_categories(vectors, max_categories=3)
    return encode.vector_rows(model.transform(vectors), "o_orderkey", "indexed_features")


def _many_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nearly as many price levels as rows, beside columns of few levels."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("customer"),
        F.concat(F.lit("p"), F.round(F.col("o_totalprice") * 100).cast("long").cast("string")).alias("price"),
        "o_orderpriority",
        "o_orderstatus",
        (F.col("o_custkey") % 7).cast("double").alias("n_seven"),
    )


def one_hot_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _many_levels(spark, sf_dir)
    slots = sparse.fit_slots(orders, ["price", "o_orderpriority", "customer"], ["n_seven"])
    return sparse.vector_cells(sparse.with_features(orders, "o_orderkey", slots), "o_orderkey", "features")


def one_hot_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Slots of the orders of some customers, applied to all orders.
    orders = _many_levels(spark, sf_dir)
    some = orders.where(F.col("o_orderkey") % 3 > 0)
    slots = sparse.fit_slots(some, ["o_orderstatus", "customer"], ["n_seven"], keep_unseen=True)
    return sparse.vector_cells(sparse.with_features(orders, "o_orderkey", slots), "o_orderkey", "features")


def encode_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _many_levels(spark, sf_dir)
    columns = ["customer", "price", "o_orderpriority", "o_orderstatus"]
    levels = encode.level_indexes(orders.where(F.col("o_orderkey") % 3 > 0), columns, "first_seen", by="o_orderkey")
    return encode.encode_columns(orders, columns, levels, keep=True)


QUERIES = {
    "string_index": string_index,
    "string_index_table": string_index_table,
    "string_index_alpha": string_index_alpha,
    "encode_first_seen": encode_first_seen,
    "index_round_trip": index_round_trip,
    "one_hot": one_hot,
    "feature_vector": feature_vector,
    "standard_scale": standard_scale,
    "vector_index": vector_index,
    "one_hot_many": one_hot_many,
    "one_hot_unseen": one_hot_unseen,
    "encode_many": encode_many,
}


def _levels(relation: str, column: str, order: str) -> str:
    return f"""(SELECT {column} AS value,
        CAST(row_number() OVER (ORDER BY {order}, {column}) - 1 AS DOUBLE) AS idx
        FROM {relation} GROUP BY {column})"""


_BY_COUNT = "count(*) DESC"
_TYPE_SLOTS = f"""
    SELECT p_partkey, CAST(s AS INTEGER) AS slot,
           CASE WHEN idx = s THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
    FROM part JOIN {_levels('part', 'p_type', _BY_COUNT)} k ON p_type = k.value,
         range((SELECT count(DISTINCT p_type) - 1 FROM part)) r(s)"""
_TYPES = "(SELECT count(DISTINCT p_type) - 1 FROM part)"

_MANY = """(SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer,
    'p' || CAST(round(o_totalprice * 100) AS BIGINT) AS price, o_orderpriority, o_orderstatus,
    CAST(o_custkey % 7 AS DOUBLE) AS n_seven FROM orders)"""
_SOME = f"(SELECT * FROM {_MANY} WHERE o_orderkey % 3 > 0)"


def _n(relation: str, column: str) -> str:
    return f"(SELECT count(DISTINCT {column}) FROM {relation})"


def _ones(relation: str, column: str, before: str, left_out: int) -> str:
    return f"""SELECT o_orderkey, CAST({before} + idx AS INTEGER) AS slot, 1.0::DOUBLE AS value
        FROM {_MANY} JOIN {_levels(relation, column, _BY_COUNT)} k ON {column} = k.value
        WHERE idx < {_n(relation, column)} - {left_out}"""


def _index(column: str) -> str:
    return f"""LEFT JOIN (SELECT {column} AS v_{column},
        CAST(row_number() OVER (ORDER BY min(o_orderkey), {column}) - 1 AS DOUBLE) AS i_{column}
        FROM {_SOME} GROUP BY {column}) ON {column} = v_{column}"""


_PRICES, _PRIORITIES = f"{_n(_MANY, 'price')} - 1", f"{_n(_MANY, 'o_orderpriority')} - 1"
_MANY_COLUMNS = ("customer", "price", "o_orderpriority", "o_orderstatus")

ORACLES = {
    "one_hot_many": f"""
        {_ones(_MANY, 'price', '0', 1)}
        UNION ALL {_ones(_MANY, 'o_orderpriority', _PRICES, 1)}
        UNION ALL {_ones(_MANY, 'customer', f'{_PRICES} + {_PRIORITIES}', 1)}
        UNION ALL SELECT o_orderkey, CAST({_PRICES} + {_PRIORITIES} + {_n(_MANY, 'customer')} - 1 AS INTEGER), n_seven
        FROM {_MANY} WHERE n_seven <> 0""",
    "one_hot_unseen": f"""
        {_ones(_SOME, 'o_orderstatus', '0', 0)}
        UNION ALL {_ones(_SOME, 'customer', _n(_SOME, 'o_orderstatus'), 0)}
        UNION ALL SELECT o_orderkey, CAST({_n(_SOME, 'o_orderstatus')} + {_n(_SOME, 'customer')} AS INTEGER), n_seven
        FROM {_MANY} WHERE n_seven <> 0""",
    "encode_many": f"""
        SELECT o_orderkey, n_seven,
               {', '.join(f'coalesce(i_{c}, CAST({_n(_SOME, c)} AS DOUBLE)) AS {c}' for c in _MANY_COLUMNS)}
        FROM {_MANY} {' '.join(map(_index, _MANY_COLUMNS))}""",
    "string_index": f"""
        SELECT p_partkey, p_type, idx AS type_index
        FROM part JOIN {_levels('part', 'p_type', _BY_COUNT)} k ON p_type = value""",
    "string_index_table": f"""
        SELECT c_custkey, c_name, idx AS name_index
        FROM customer JOIN {_levels('customer', 'c_name', _BY_COUNT)} k ON c_name = value""",
    "string_index_alpha": f"""
        SELECT p_partkey, p_brand, idx AS brand_index
        FROM part JOIN {_levels('part', 'p_brand', 'p_brand')} k ON p_brand = value""",
    "encode_first_seen": f"""
        SELECT p_partkey, p_brand, idx AS brand_index
        FROM part JOIN {_levels('part', 'p_brand', 'min(p_partkey)')} k ON p_brand = value""",
    "index_round_trip": f"""
        SELECT c_custkey, c_mktsegment, idx AS segment_index, c_mktsegment AS segment_again
        FROM customer JOIN {_levels('customer', 'c_mktsegment', _BY_COUNT)} k
        ON c_mktsegment = value""",
    "one_hot": _TYPE_SLOTS,
    "feature_vector": f"""
        {_TYPE_SLOTS}
        UNION ALL SELECT p_partkey, CAST({_TYPES} AS INTEGER), CAST(p_size AS DOUBLE) FROM part
        UNION ALL SELECT p_partkey, CAST({_TYPES} + 1 AS INTEGER), p_retailprice FROM part""",
    "standard_scale": """
        SELECT p_partkey, 0::INTEGER AS slot,
               round(p_size / (SELECT stddev_samp(p_size) FROM part), 6) AS value FROM part
        UNION ALL SELECT p_partkey, 1::INTEGER,
               round(p_retailprice / (SELECT stddev_samp(p_retailprice) FROM part), 6) FROM part
        UNION ALL SELECT p_partkey, 2::INTEGER, 0.0::DOUBLE FROM part""",
    "vector_index": """
        SELECT o_orderkey, 0::INTEGER AS slot,
               CASE o_orderstatus WHEN 'O' THEN 0.0::DOUBLE WHEN 'F' THEN 1.0::DOUBLE
                    ELSE 2.0::DOUBLE END AS value FROM orders
        UNION ALL SELECT o_orderkey, 1::INTEGER, o_totalprice FROM orders""",
}
