"""Null profile, numeric summary, exact quantiles and modes."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions import text
from tallymark.operators.shape import text_columns


def missing_profile(df: DataFrame, words: Sequence[str] = ()) -> DataFrame:
    """(column, n_missing, pct) for every column, from one pass.

    With ``words``, those texts count as missing too.
    """
    texts = set(text_columns(df)) if words else set()
    n_missing = {
        c: F.count_if(text.is_missing(c, words) if c in texts else F.col(c).isNull())
        for c in df.columns
    }
    one_row = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[e.alias(c) for c, e in n_missing.items()]
    )
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in df.columns]
    return one_row.select("__rows", F.inline(F.array(*cells))).select(
        "column",
        "n_missing",
        F.when(F.col("__rows") > 0, F.col("n_missing") * 100.0 / F.col("__rows")).alias("pct"),
    )


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, stddev, min, max) per column, from one pass."""
    measures = {
        "count": F.count,
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    one_row = df.agg(
        *[
            F.struct(*[f(F.col(c)).alias(n) for n, f in measures.items()]).alias(c)
            for c in columns
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(c).getField(n).alias(n) for n in measures])
            for c in columns
        ]
    )
    return one_row.select(F.inline(rows))


def _number(columns: Sequence[str]) -> dict[str, int]:
    """Columns by position: shuffles carry a small number instead of a name."""
    return {c: i for i, c in enumerate(columns)}


def _named(df: DataFrame, columns: Sequence[str], rest: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in columns])
    return df.select(names[F.col("column")].alias("column"), *rest)


def _value_counts(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """(column, value, n): one row per distinct non-null value of each column."""
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("column"), F.col(c).cast(kind).alias("value"))
            for c, i in _number(columns).items()
        ]
    )
    return (
        df.select(F.inline(cells))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


_BUCKETS = 1024  # parts that a range of values is cut into per pass
_LIST = 10_000  # rows of a range whose values are listed


@dataclass(frozen=True)
class _Range:
    """Values from ``low`` to ``high``, both of which occur; ``before`` rows are smaller."""

    column: int
    low: float
    high: float
    before: int
    rows: int

    def holds(self, rank: int) -> bool:
        return self.before <= rank < self.before + self.rows

    @property
    def settled(self) -> bool:
        return self.low == self.high

    def bucket(self, value: Column) -> Column:
        """Equal parts of the finite range; infinities have parts of their own."""
        low = max(self.low, -_LARGEST)
        high = min(self.high, _LARGEST)
        half = 0.5 if math.isinf(high - low) else 1.0
        width = high * half - low * half
        share = (value * half - F.lit(low * half)) / F.lit(width) if width > 0 else F.lit(0.0)
        inside = F.least(F.floor(share * _BUCKETS), F.lit(_BUCKETS - 1))
        return F.when(value < low, -1).when(value > high, _BUCKETS).otherwise(inside).cast("int")


_LARGEST = sys.float_info.max


def _present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    numbers = {str(i): F.col(c).cast("double") for c, i in _number(columns).items()}
    return df.select(*[F.when(~F.isnan(v), v).alias(n) for n, v in numbers.items()])


def _within(present: DataFrame, ranges: Sequence[_Range], part: Callable[[_Range, Column], Column]) -> DataFrame:
    """(range, value, part): the cells that lie in one of ``ranges``."""
    cells = [
        F.when(
            F.col(str(r.column)).between(r.low, r.high),
            F.struct(
                F.lit(i).alias("range"),
                F.col(str(r.column)).alias("value"),
                part(r, F.col(str(r.column))).alias("part"),
            ),
        )
        for i, r in enumerate(ranges)
    ]
    return present.select(F.explode(F.array(*cells)).alias("cell")).where("cell IS NOT NULL").select("cell.*")


def _narrowed(present: DataFrame, ranges: Sequence[_Range], ranks: Mapping[int, set[int]]) -> list[_Range]:
    """Each range cut into parts; those that hold a wanted rank."""
    counted = _within(present, ranges, lambda r, v: r.bucket(v)).groupBy("range", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    before = {i: r.before for i, r in enumerate(ranges)}
    found = []
    for row in sorted(counted.collect(), key=lambda row: (row["range"], row.part)):
        i = row["range"]
        part = _Range(ranges[i].column, row.low, row.high, before[i], row.rows)
        before[i] += row.rows
        if any(part.holds(rank) for rank in ranks[part.column]):
            found.append(part)
    return found


def _listed(present: DataFrame, ranges: Sequence[_Range]) -> list[_Range]:
    """Every distinct value of short ranges as a range of its own."""
    counted = _within(present, ranges, lambda r, v: F.lit(0)).groupBy("range", "value").agg(
        F.count(F.lit(1)).alias("rows")
    )
    before = {i: r.before for i, r in enumerate(ranges)}
    found = []
    for row in sorted(counted.collect(), key=lambda row: (row["range"], row.value)):
        i = row["range"]
        found.append(_Range(ranges[i].column, row.value, row.value, before[i], row.rows))
        before[i] += row.rows
    return found


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(column, probability, value): exact, linearly interpolated quantiles.

    NULL and NaN are left out; a column without values has no rows.  Nothing is
    sorted or shuffled but counts: every pass over the table cuts the ranges of
    values that hold a wanted rank into parts, counts the rows of each, and goes
    on with the parts that hold the rank, until a part has one value or a few
    thousand rows, whose values are then listed.  Some thousand rows per
    quantile reach the driver, whatever the size of the table.
    """
    present = _present(df, columns)
    sums = present.agg(
        *[F.struct(F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in present.columns]
    ).first()
    whole = {i: sums[str(i)] for i in range(len(columns)) if sums[str(i)].n}
    wanted = {i: [(row.n - 1) * float(p) for p in probabilities] for i, row in whole.items()}
    ranks = {i: {f(rank) for rank in rows for f in (math.floor, math.ceil)} for i, rows in wanted.items()}
    pending = [_Range(i, row.low, row.high, 0, row.n) for i, row in whole.items()]
    settled: list[_Range] = []
    while pending:
        settled += [r for r in pending if r.settled]
        short = [r for r in pending if not r.settled and r.rows <= _LIST]
        long = [r for r in pending if not r.settled and r.rows > _LIST]
        if short:
            settled += _listed(present, short)
        pending = _narrowed(present, long, ranks) if long else []

    def at(column: int, rank: int) -> float:
        return next(r.low for r in settled if r.column == column and r.holds(rank))

    rows = []
    for i, places in wanted.items():
        for p, rank in zip(probabilities, places):
            low, high = at(i, math.floor(rank)), at(i, math.ceil(rank))
            rows.append((columns[i], float(p), low if low == high else low + (rank - math.floor(rank)) * (high - low)))
    return df.sparkSession.createDataFrame(rows, "column string, probability double, value double")


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value): most frequent non-null value, written as text.

    The smallest value wins ties, in the order of the column's own type.
    Counts per value come first, so the second aggregate keeps one candidate
    per column and task instead of a map of all values.  Columns of the same
    type share one pass.
    """
    by_type: dict[str, list[str]] = {}
    for field in df.select(*columns).schema:
        by_type.setdefault(field.dataType.simpleString(), []).append(field.name)
    best = F.min_by("value", F.struct(-F.col("n"), F.col("value"))).cast("string")
    parts = [
        _named(
            _value_counts(df, names, kind).groupBy("column").agg(best.alias("value")),
            names,
            ["value"],
        )
        for kind, names in by_type.items()
    ]
    return reduce(DataFrame.unionByName, parts)
