"""Choosing, naming, ordering and filtering columns and rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions import text


def with_label(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Keep ``columns`` and add a copy of ``target`` under the name ``label``."""
    return df.select(*columns, F.col(target).alias("label"))


def target_last(df: DataFrame, target: str) -> DataFrame:
    """Move ``target`` behind all other columns."""
    return df.select(*[c for c in df.columns if c != target], target)


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename some columns and keep the rest."""
    return df.withColumnsRenamed(dict(names))


def renamed_by_position(df: DataFrame, names: Mapping[int, str]) -> DataFrame:
    """Rename columns by their position, counted from 0."""
    return df.toDF(*[names.get(i, c) for i, c in enumerate(df.columns)])


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def replaced(df: DataFrame, expressions: Mapping[str, Column]) -> DataFrame:
    """Replace columns in place with one projection, keeping order."""
    return df.select(
        *[expressions[c].alias(c) if c in expressions else F.col(c) for c in df.columns]
    )


def trim_all(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trim the listed text columns, or all of them."""
    return replaced(df, {c: text.trimmed(c) for c in columns or text_columns(df)})


def underscore_all(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace blanks by underscores in the listed text columns, or all of them."""
    return replaced(df, {c: text.underscored(c) for c in columns or text_columns(df)})


def missing_words_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn missing-value words into NULL in the listed text columns, or all of them."""
    return replaced(df, {c: text.missing_to_null(c) for c in columns or text_columns(df)})


def missing_words_to_value(
    df: DataFrame, value: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Turn NULL and missing-value words into ``value`` in text columns."""
    return replaced(
        df, {c: text.missing_to_value(c, value) for c in columns or text_columns(df)}
    )


def whole_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast columns to decimal(10,0), rounding half up; unreadable text gives NULL."""
    return replaced(df, {c: text.whole_number(c) for c in columns})


def equal_to(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Rows whose column equals ``value``; reaches the scan as a pushed filter."""
    return df.where(F.col(column) == F.lit(value))


def greater_than(df: DataFrame, column: str, bound: float) -> DataFrame:
    """Rows whose column exceeds ``bound``; reaches the scan as a pushed filter."""
    return df.where(F.col(column) > F.lit(bound))


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any of the columns."""
    return df.na.drop("any", subset=list(columns) if columns else None)
