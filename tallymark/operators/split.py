"""Repeatable row splits from a stable key.

The part of a row depends only on its key, so a split is the same after a
repartition, a retry, or a rerun on a bigger cluster, and costs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.ordered import running_sums
from tallymark.session import reliable_copy

_DIGITS = 8  # hex digits of the digest that decide
_STEPS = 16**_DIGITS
_MISSING = "\u0000"  # stands for NULL in a key


def draw(key: str | Sequence[str], salt: str = "") -> Column:
    """A number from 0 to 2**32 - 1 that depends on the key's text alone.

    It is made of the first digits of an MD5; ``salt`` gives another draw.
    Several columns are joined with a separator.  A NULL counts as a value of
    its own, so rows without a key have a draw, too, all the same one.
    """
    names = [key] if isinstance(key, str) else list(key)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(_MISSING)) for c in names]
    content = F.concat_ws("|", *texts)
    if salt:
        content = F.concat(F.lit(salt), content)
    return F.conv(F.substring(F.md5(content), 1, _DIGITS), 16, 10).cast("bigint")


def cut(fraction: float) -> int:
    """The draw below which ``fraction`` of all keys fall."""
    return round(fraction * _STEPS)


def between(key: str | Sequence[str], start: int, end: int, salt: str = "") -> Column:
    """True for draws from ``start`` up to but not including ``end``."""
    if start >= end:
        return F.lit(False)
    if start <= 0 and end >= _STEPS:
        return F.lit(True)
    number = draw(key, salt)
    return (number >= start) & (number < end)


def below(key: str | Sequence[str], fraction: float, salt: str = "") -> Column:
    """True for about ``fraction`` of the keys; 0 takes none, 1 all."""
    return between(key, 0, cut(fraction), salt)


def split(
    df: DataFrame, key: str | Sequence[str], weights: Sequence[float], salt: str = ""
) -> list[DataFrame]:
    """Disjoint parts in proportion to ``weights``; together they are the table.

    A part of weight 0 is empty.  Weights must not be negative or all 0.
    """
    total = float(sum(weights))
    if total <= 0 or min(weights) < 0:
        raise ValueError("weights must not be negative, and one must be positive")
    last = max(i for i, weight in enumerate(weights) if weight > 0)
    parts, start, done = [], 0, 0.0
    for i, weight in enumerate(weights):
        done += weight
        end = _STEPS if i >= last else cut(done / total)
        parts.append(df.where(between(key, start, end, salt)))
        start = end
    return parts


def with_stratified_part(
    df: DataFrame, key: str | Sequence[str], label: str, weights: Sequence[float], name: str = "part", salt: str = ""
) -> DataFrame:
    """Add a part number that takes the exact share of every class of ``label``.

    The rows of a class are ranked by a digest of their key and cut where its
    quotas end, rounded halves up, so part sizes are off by half a row at most.
    Ranks come from ranges of rows, so a class with a third of all rows is spread
    like any other.  Rows without a label are a class of their own.  Rows that
    repeat a key are told apart by their other columns; equal rows are
    interchangeable.
    """
    total = float(sum(weights))
    if total <= 0 or min(weights) < 0:
        raise ValueError("weights must not be negative, and one must be positive")
    names = [key] if isinstance(key, str) else list(key)
    rows = df.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(label).cast("string"), F.lit(_MISSING)).alias("class"),
        draw(key, salt).alias("draw"),
        F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(_MISSING)) for c in names]).alias("key"),
        F.xxhash64(*df.columns).alias("rest"),
    )
    order = [F.asc(c) for c in ("draw", "key", "rest")]
    counted = running_sums(rows, order, {"rank": F.lit(1)}, group="class")
    part = F.lit(len(weights) - 1)
    for i in reversed(range(len(weights) - 1)):
        done = float(sum(weights[: i + 1]))
        quota = F.floor(F.col("rank_all") * F.lit(done / total) + F.lit(0.5))
        part = F.when(F.col("rank") <= quota, i).otherwise(part)
    return counted.select("row.*", part.cast("int").alias(name))


def split_stratified(
    df: DataFrame, key: str | Sequence[str], label: str, weights: Sequence[float], salt: str = ""
) -> list[DataFrame]:
    """Disjoint parts, each with its exact share of every class; together they are the table."""
    parts = reliable_copy(with_stratified_part(df, key, label, weights, "__part", salt))
    return [parts.where(F.col("__part") == i).drop("__part") for i in range(len(weights))]


def with_fold(
    df: DataFrame, key: str | Sequence[str], folds: int, name: str = "fold", salt: str = "fold"
) -> DataFrame:
    """Add a fold number 0..folds-1 for cross-validation."""
    return df.withColumn(name, (draw(key, salt) % folds).cast("int"))
