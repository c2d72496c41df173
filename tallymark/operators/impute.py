"""Filling missing values with constants or with statistics of a table.

A statistic is a one-row DataFrame with one column per filled column, so it can
be taken from the training table and applied to any other table.  It reaches
the filled table as a scalar subquery: no join and nothing held on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

from tallymark.operators import profile
from tallymark.operators.shape import replaced, text_columns


def fill_numbers(df: DataFrame, value: float = 0) -> DataFrame:
    """Fill NULL in numeric columns only."""
    return df.na.fill(value)


def fill_text(df: DataFrame, sentinel: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill NULL in text columns only."""
    return df.na.fill(sentinel, subset=list(columns or text_columns(df)))


def fill_columns(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Fill NULL column by column; text values are converted for numeric columns."""
    return df.na.fill(dict(values))


def means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row holding the mean of each column."""
    return df.agg(*[F.avg(c).alias(c) for c in columns])


def _one_row(long: DataFrame, columns: Sequence[str]) -> DataFrame:
    return long.agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns]
    )


def medians(df: DataFrame, columns: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """One row holding the median of each column.

    Exact unless ``accuracy`` is given; then a one-pass sketch whose rank error
    is at most rows / accuracy.
    """
    if accuracy is not None:
        return df.agg(*[F.percentile_approx(c, 0.5, accuracy).alias(c) for c in columns])
    return _one_row(profile.quantiles(df, columns, [0.5]), columns)


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row holding the most frequent value of each column, in its own type."""
    row = _one_row(profile.modes(df, columns), columns)
    types = {f.name: f.dataType for f in df.schema}
    return row.select(*[F.col(c).cast(types[c]).alias(c) for c in columns])


def fill_from(df: DataFrame, statistic: DataFrame) -> DataFrame:
    """Fill NULL in every column that ``statistic`` has, with its value."""
    columns = statistic.columns
    packed = statistic.select(F.struct(*columns).alias("s")).scalar()
    return replaced(
        df, {c: F.coalesce(F.col(c), packed.getField(c)) for c in columns}
    )


def central(train: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with a central value of every column: median of numbers, mode of the rest.

    Modes keep the smallest of equally frequent values.  Medians are exact; those
    of whole-number columns are rounded half up to a value of the column.  The row
    of a training table may fill any other, with ``fill_from``.  Columns without
    any value have none.
    """
    chosen = [f for f in train.schema if columns is None or f.name in columns]
    numbers = [f for f in chosen if isinstance(f.dataType, NumericType)]
    others = [f.name for f in chosen if not isinstance(f.dataType, NumericType)]
    whole = lambda f: F.floor(F.col(f.name) + 0.5) if isinstance(f.dataType, IntegralType) else F.col(f.name)
    if not numbers:
        return modes(train, others)
    middle = medians(train, [f.name for f in numbers]).select(*[whole(f).cast(f.dataType).alias(f.name) for f in numbers])
    if not others:
        return middle
    packed = middle.select(F.struct(*middle.columns).alias("s")).scalar()
    found = modes(train, others).select("*", *[packed.getField(f.name).alias(f.name) for f in numbers])
    return found.select(*[f.name for f in chosen])


def central_impute(df: DataFrame, train: DataFrame | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill the gaps of a mixed table with central values of ``train`` (of the table itself without one)."""
    return fill_from(df, central(df if train is None else train, columns))
