"""Joining a table to lists of ids.

Lists are reduced to one row per id before a join, so rows never multiply and a
hot list id costs nothing.  No side is broadcast by hand: the optimizer does so
when the measured size allows, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.labels import membership_code


def id_list(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct non-null ids of one column."""
    return df.where(F.col(column).isNotNull()).select(F.col(column).alias(name)).distinct()


def mark_in_list(df: DataFrame, key: str, ids: DataFrame, name: str) -> DataFrame:
    """Left-join a distinct id list; ``name`` holds the id, or NULL when not listed."""
    listed = ids.toDF(name)
    return df.join(listed, F.col(key) == F.col(name), "left")


def list_flags(lists: DataFrame, first: str, second: str, key: str) -> DataFrame:
    """One row per id with ``in_first`` / ``in_second``.

    ``lists`` holds two unrelated id columns side by side.  Each is read on its
    own, so only its column is scanned; one shuffle of partial results joins them.
    """

    def entries(column: str, in_first: bool) -> DataFrame:
        return lists.where(F.col(column).isNotNull()).select(
            F.col(column).alias(key), F.lit(in_first).alias("a"), F.lit(not in_first).alias("b")
        )

    return (
        entries(first, True)
        .unionByName(entries(second, False))
        .groupBy(key)
        .agg(F.max("a").alias("in_first"), F.max("b").alias("in_second"))
    )


def mark_in_lists(
    df: DataFrame, key: str, flags: DataFrame, first: str, second: str
) -> DataFrame:
    """Left-join two lists at once; each new column holds the id, or NULL when not listed.

    Both lists come from ``list_flags``, so they are grouped and joined once.
    """
    marked = df.join(flags.toDF(key, "__a", "__b"), key, "left")
    return marked.select(
        *df.columns,
        F.when(F.col("__a"), F.col(key)).alias(first),
        F.when(F.col("__b"), F.col(key)).alias(second),
    )


def in_both_lists(df: DataFrame, key: str, flags: DataFrame) -> DataFrame:
    """Rows whose key is on both lists of ``list_flags``."""
    both = flags.toDF(key, "__a", "__b").where(F.col("__a") & F.col("__b")).select(key)
    return df.join(both, key).select(*df.columns)


def with_membership(
    df: DataFrame, key: str, flags: DataFrame, name: str = "test_results", one_sided: int = 3
) -> DataFrame:
    """Add the membership code of every row's key; exactly one row per input row."""
    code: Column = membership_code(
        F.coalesce(F.col("in_first"), F.lit(False)),
        F.coalesce(F.col("in_second"), F.lit(False)),
        one_sided,
    )
    return df.join(flags, key, "left").withColumn(name, code).drop("in_first", "in_second")


def left_join_either_key(
    df: DataFrame, key: str, pairs: DataFrame, first: str, second: str
) -> DataFrame:
    """Left join on ``first = key OR second = key`` as equi joins.

    An OR condition would be planned as a nested loop over all pairs.  Each
    right row is listed once under every distinct key it carries instead.
    Matches use an inner join, which can split a hot key on either side;
    rows without a match are added by an anti join.
    """
    by_key = pairs.select(
        first,
        second,
        F.explode(F.array_distinct(F.array(first, second))).alias("__key"),
    ).where(F.col("__key").isNotNull())
    matched = df.join(by_key, F.col(key) == F.col("__key")).drop("__key")
    # distinct() leaves one row per key, so no key is hot in the anti join.
    known = by_key.select("__key").distinct()
    unmatched = df.join(known, F.col(key) == F.col("__key"), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
