"""Totals and ranks along a global order, without a single-task sort.

A plain ``sum(...) over (order by ...)`` puts every row into one task.  Here the
rows are laid out by range, each range is summed on its own, and only one
subtotal per range is accumulated globally.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import reliable_copy

_RANGE = "__range"


def running_sums(
    points: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, Column],
    group: str | None = None,
    wanted: Callable[[], Column] | None = None,
) -> DataFrame:
    """Add running totals along ``order``, which must not have ties.

    For every name in ``totals`` the result gains ``name`` (the total up to and
    including the row) and ``name_all`` (the total of all rows).  With ``group``
    both restart for each value of that column, which should have few values.

    ``points`` should already be reduced to one row per order value, so a value
    shared by a third of the raw table is one row here.  It is copied once,
    because range numbers must not change between the two reads of it.

    ``wanted`` may pick ranges, by ``name_before``, ``name_range`` and
    ``name_all``; rows of other ranges are then neither sorted nor returned.
    """
    keys = [group] if group else []
    laid_out = reliable_copy(points.repartitionByRange(*keys, *order)).withColumn(
        _RANGE, F.spark_partition_id()
    )
    subtotals = laid_out.groupBy(*keys, _RANGE).agg(
        *[F.sum(c).alias(f"{n}_range") for n, c in totals.items()]
    )
    # At most one row per range and group value: the number of shuffle
    # partitions bounds this window and the broadcast below, not the data.
    groups = Window.partitionBy(*keys)
    earlier = groups.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = subtotals.select(
        "*",
        *[F.coalesce(F.sum(f"{n}_range").over(earlier), F.lit(0)).alias(f"{n}_before") for n in totals],
        *[F.sum(f"{n}_range").over(groups).alias(f"{n}_all") for n in totals],
    )
    if wanted is not None:
        offsets = offsets.where(wanted())
    within = (
        Window.partitionBy(*keys, _RANGE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Groups may be many: then the sizes decide how the offsets are joined.
    joined = laid_out.join(offsets if group else F.broadcast(offsets), [*keys, _RANGE])
    return joined.select(
        *points.columns,
        *[(F.sum(c).over(within) + F.col(f"{n}_before")).alias(n) for n, c in totals.items()],
        *[F.col(f"{n}_all") for n in totals],
    )


def ranked(
    points: DataFrame, order: Sequence[Column], name: str = "rank", group: str | None = None
) -> DataFrame:
    """Number the rows 0, 1, 2, ... along ``order``, which must not have ties."""
    counted = running_sums(points, order, {name: F.lit(1)}, group)
    return counted.select(*points.columns, (F.col(name) - 1).alias(name))


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows along ``order``; every task keeps at most ``n`` rows."""
    return df.orderBy(*order).limit(n)
