"""Grouped sums, counts, shares and distinct rows.

All of them are one partial aggregate, one shuffle of partial results and one
final aggregate, so a key that holds a third of the rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_by(df: DataFrame, keys: Sequence[str | Column], amount: Column, name: str) -> DataFrame:
    """Sum of ``amount`` per combination of keys."""
    return df.groupBy(*keys).agg(F.sum(amount).alias(name))


def distinct_of(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """Distinct combinations of the columns."""
    return df.select(*columns).distinct()


def class_shares(df: DataFrame, target: str) -> DataFrame:
    """Rows per class, the number of all rows, and the class's share of them.

    The total is a scalar over the grouped counts, whose shuffle is reused, so
    the table is read once.
    """
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(target, "count", total.alias("total")).withColumn(
        "share", F.col("count") / F.col("total")
    )


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and number of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns))
    )


def with_global_mean(df: DataFrame, column: str, name: str) -> DataFrame:
    """The mean of the whole column beside every row.

    The mean is a scalar subquery: no window, no sort, no shuffle of the rows.
    """
    return df.withColumn(name, df.agg(F.avg(column)).scalar())


def class_count(df: DataFrame, label: str) -> DataFrame:
    """One row: number of classes when labels are 0, 1, ..., k-1."""
    return df.agg((F.max(label) + 1).alias("n_classes"))
