"""Expressions for dirty text: blanks, missing-value words, tolerant casts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that stand for "no value" in the raw files.
MISSING_WORDS = ("", "NA", "NULL")


def trimmed(name: str) -> Column:
    """The text without blanks at either end."""
    return F.trim(F.col(name))


def underscored(name: str) -> Column:
    """Every blank inside the text replaced by an underscore."""
    return F.replace(F.col(name), F.lit(" "), F.lit("_"))


def is_missing(name: str, words: Sequence[str] = MISSING_WORDS) -> Column:
    """True for NULL and for the missing-value words, blanks around them ignored."""
    return F.col(name).isNull() | trimmed(name).isin(*words)


def missing_to_null(name: str, words: Sequence[str] = MISSING_WORDS) -> Column:
    """NULL where the value is missing, the untouched text elsewhere."""
    return F.when(~is_missing(name, words), F.col(name))


def missing_to_value(name: str, value: str, words: Sequence[str] = MISSING_WORDS) -> Column:
    """``value`` where the text is missing, the untouched text elsewhere."""
    return F.when(is_missing(name, words), F.lit(value)).otherwise(F.col(name))


def whole_number(name: str) -> Column:
    """Cast to decimal(10,0), rounding half up; text that is no number gives NULL."""
    return F.col(name).try_cast("decimal(10,0)")
