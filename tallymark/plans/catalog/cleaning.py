"""Text clean-up, null profile, imputation, summaries, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions import labels
from tallymark.operators import impute, profile, shape, split
from tallymark.sources.readers import table


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with missing values put in: the tables themselves have none.

    ``amount`` and ``kind`` are NULL for errors; ``note`` carries padding and
    every missing-value word.
    """
    note = (
        F.when(F.col("event_type") == "error", "NA")
        .when(F.col("event_type") == "signup", " NULL ")
        .when(F.col("event_type") == "view", "  ")
        .when(F.col("event_type") == "purchase", F.lit(None))
        .otherwise(F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")))
    )
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(~failed, F.col("value")).alias("amount"),
        F.when(~failed, F.col("event_type")).alias("kind"),
        note.alias("note"),
    )


_EVENTS_SQL = """
    (SELECT event_id,
            CASE WHEN event_type <> 'error' THEN value END AS amount,
            CASE WHEN event_type <> 'error' THEN event_type END AS kind,
            CASE event_type WHEN 'error' THEN 'NA' WHEN 'signup' THEN ' NULL '
                 WHEN 'view' THEN '  ' WHEN 'purchase' THEN NULL
                 ELSE '  ' || event_type || ' ' END AS note
     FROM events)"""


def fill_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute.fill_numbers(_events(spark, sf_dir), 0)


def drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.complete_rows(_events(spark, sf_dir))


def fill_text_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Fixed value: the text that marks an unknown in prepared test tables.
    return impute.fill_text(_events(spark, sf_dir), "999999")


def fill_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute.fill_columns(_events(spark, sf_dir), {"amount": "-1", "kind": "-1"})


def sentinel_to_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.missing_words_to_value(_events(spark, sf_dir), "0")


def mean_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).select("event_id", "amount")
    filled = impute.fill_from(events, impute.means(events, ["amount"]))
    return filled.withColumn("amount", F.round("amount", 6))


def median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).select("event_id", "amount")
    filled = impute.fill_from(events, impute.medians(events, ["amount"]))
    return filled.withColumn("amount", F.round("amount", 6))


def mode_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).select("event_id", "amount", "kind")
    return impute.fill_from(events, impute.modes(events, ["amount", "kind"]))


def central_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixed table filled in one call: medians of numbers, modes of texts."""
    events = _events(spark, sf_dir).select(
        "event_id", "amount", "kind", F.when(F.col("event_id") % 3 > 0, F.col("event_id") % 11).alias("elevenths")
    )
    filled = impute.central_impute(events, columns=["amount", "kind", "elevenths"])
    return filled.withColumn("amount", F.round("amount", 6))


def missing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.missing_profile(_events(spark, sf_dir), words=("", "NA", "NULL"))
    return found.withColumn("pct", F.round("pct", 6))


_MEASURED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = profile.numeric_summary(table(spark, sf_dir, "lineitem"), _MEASURED)
    return summary.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


def quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.quantiles(table(spark, sf_dir, "lineitem"), _MEASURED, [0.25, 0.5, 0.75])
    return found.withColumn("value", F.round("value", 6))


def _padded_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        *[
            F.concat(F.lit("  "), F.col(c), F.lit(" ")).alias(c)
            for c in ("p_name", "p_brand", "p_type")
        ],
    )


def trim_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.trim_all(_padded_parts(spark, sf_dir))


def spaces_to_underscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.underscore_all(_padded_parts(spark, sf_dir))


def try_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("p_type") == "PROMO", "NA").otherwise(F.col("p_retailprice").cast("string"))
    parts = table(spark, sf_dir, "part").select("p_partkey", price.alias("price"))
    return shape.whole_numbers(parts, ["price"]).withColumn("price", F.col("price").cast("bigint"))


def binary_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey", labels.binary_label("o_orderpriority", "1-URGENT").alias("label")
    )


def split_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    train, test = split.split(orders, "o_orderkey", [0.7, 0.3])
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


QUERIES = {
    "fill_zero": fill_zero,
    "drop_null_rows": drop_null_rows,
    "fill_text_sentinel": fill_text_sentinel,
    "fill_by_column": fill_by_column,
    "sentinel_to_value": sentinel_to_value,
    "mean_impute": mean_impute,
    "median_impute": median_impute,
    "mode_impute": mode_impute,
    "central_impute": central_impute,
    "missing_profile": missing_profile,
    "numeric_summary": numeric_summary,
    "quartiles": quartiles,
    "trim_columns": trim_columns,
    "spaces_to_underscores": spaces_to_underscores,
    "try_decimal": try_decimal,
    "binary_label": binary_label,
    "split_fraction": split_fraction,
}


def _missing(column: str) -> str:
    return f"({column} IS NULL OR trim({column}) IN ('', 'NA', 'NULL'))"


def _profile_row(column: str, condition: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) FILTER ({condition}) AS n_missing,
        round(count(*) FILTER ({condition}) * 100.0::DOUBLE / count(*), 6) AS pct
        FROM {_EVENTS_SQL}"""


def _summary_row(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS count,
        round(avg({column}), 4) AS mean, round(stddev_samp({column}), 4) AS stddev,
        min({column}) AS min, max({column}) AS max FROM lineitem"""


_MODE = """(SELECT {0} FROM {1} WHERE {0} IS NOT NULL
            GROUP BY {0} ORDER BY count(*) DESC, {0} LIMIT 1)"""

ORACLES = {
    "fill_zero": f"SELECT event_id, coalesce(amount, 0) AS amount, kind, note FROM {_EVENTS_SQL}",
    "drop_null_rows": f"""
        SELECT * FROM {_EVENTS_SQL}
        WHERE amount IS NOT NULL AND kind IS NOT NULL AND note IS NOT NULL""",
    "fill_text_sentinel": f"""
        SELECT event_id, amount, coalesce(kind, '999999') AS kind,
               coalesce(note, '999999') AS note FROM {_EVENTS_SQL}""",
    "fill_by_column": f"""
        SELECT event_id, coalesce(amount, -1) AS amount, coalesce(kind, '-1') AS kind, note
        FROM {_EVENTS_SQL}""",
    "sentinel_to_value": f"""
        SELECT event_id, amount, CASE WHEN {_missing('kind')} THEN '0' ELSE kind END AS kind,
               CASE WHEN {_missing('note')} THEN '0' ELSE note END AS note
        FROM {_EVENTS_SQL}""",
    "mean_impute": f"""
        SELECT event_id, round(coalesce(amount, (SELECT avg(amount) FROM {_EVENTS_SQL})), 6)
               AS amount
        FROM {_EVENTS_SQL}""",
    "median_impute": f"""
        SELECT event_id, round(coalesce(amount, (SELECT median(amount) FROM {_EVENTS_SQL})), 6)
               AS amount
        FROM {_EVENTS_SQL}""",
    "mode_impute": f"""
        SELECT event_id, coalesce(amount, {_MODE.format('amount', _EVENTS_SQL)}) AS amount,
               coalesce(kind, {_MODE.format('kind', _EVENTS_SQL)}) AS kind
        FROM {_EVENTS_SQL}""",
    "central_impute": f"""
        WITH e AS (SELECT event_id, amount, kind, CASE WHEN event_id % 3 > 0 THEN event_id % 11 END AS elevenths
                   FROM {_EVENTS_SQL})
        SELECT event_id, round(coalesce(amount, (SELECT median(amount) FROM e)), 6) AS amount,
               coalesce(kind, {_MODE.format('kind', 'e')}) AS kind,
               coalesce(elevenths, (SELECT CAST(floor(median(elevenths) + 0.5) AS BIGINT) FROM e)) AS elevenths
        FROM e""",
    "missing_profile": " UNION ALL ".join(
        [
            _profile_row("event_id", "event_id IS NULL"),
            _profile_row("amount", "amount IS NULL"),
            _profile_row("kind", _missing("kind")),
            _profile_row("note", _missing("note")),
        ]
    ),
    "numeric_summary": " UNION ALL ".join(_summary_row(c) for c in _MEASURED),
    "quartiles": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {p}::DOUBLE AS probability,
            round(quantile_cont({c}, {p}), 6) AS value FROM lineitem"""
        for c in _MEASURED
        for p in (0.25, 0.5, 0.75)
    ),
    "trim_columns": "SELECT p_partkey, trim(p_name) AS p_name, p_brand, p_type FROM part",
    "spaces_to_underscores": """
        SELECT p_partkey, replace('  ' || p_name || ' ', ' ', '_') AS p_name,
               replace('  ' || p_brand || ' ', ' ', '_') AS p_brand,
               replace('  ' || p_type || ' ', ' ', '_') AS p_type
        FROM part""",
    "try_decimal": """
        SELECT p_partkey,
               CASE WHEN p_type = 'PROMO' THEN NULL
                    ELSE CAST(CAST(p_retailprice AS DECIMAL(10, 0)) AS BIGINT) END AS price
        FROM part""",
    "binary_label": """
        SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS label
        FROM orders""",
    "split_fraction": """
        SELECT o_orderkey, o_totalprice,
               CASE WHEN substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) < 'b3333333'
                    THEN 'train' ELSE 'test' END AS part
        FROM orders""",
}
