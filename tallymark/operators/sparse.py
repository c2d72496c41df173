"""Indicator vectors of columns with any number of levels.

``encode.feature_stages`` keeps label lists on the driver and one attribute per
slot in the schema, which is for columns whose levels have been counted.  Here
the slots are a distributed table (column, value, slot): the slots of columns with
few levels are broadcast; the other cells of a row are laid out, joined with the
table, all columns in one join, and grouped into a sparse vector.  The driver
knows the number of levels of each column and nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallymark.operators.encode import level_indexes, narrow_columns
from tallymark.session import reliable_copy

_VECTOR = StructType([StructField("v", VectorUDT())])


@dataclass(frozen=True)
class Slots:
    """Where the cells of a table go in a feature vector."""

    levels: DataFrame  # column, value, slot; NULL for a level that is left out
    first: Mapping[str, int]  # text column -> its first slot
    numbers: Mapping[str, int]  # number column -> its slot
    size: int
    keep_unseen: bool
    narrow: Sequence[str] = ()  # text columns whose levels may be broadcast together


def fit_slots(
    train: DataFrame, categories: Sequence[str], numbers: Sequence[str] = (), keep_unseen: bool = False
) -> Slots:
    """Number the slots of the training table's levels: text columns first, then numbers.

    Levels go by frequency, ties by value, and the last one of each column has no
    slot, so a column of one level has none.  With ``keep_unseen`` every level has
    one, and values that are missing or not in the training table have none;
    otherwise such values fail the job.  That is how ``encode.feature_stages``
    numbers them.
    """
    if not categories:
        none = train.sparkSession.createDataFrame([], "column string, value string, slot int")
        return Slots(none, {}, {c: i for i, c in enumerate(numbers)}, len(numbers), keep_unseen)
    levels = reliable_copy(level_indexes(train, categories))
    counts = {r["column"]: r["n"] for r in levels.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, size = {}, 0
    for column in categories:
        first[column] = size
        size += max(0, counts.get(column, 0) - (not keep_unseen))
    start, width = F.lit(None).cast("long"), F.lit(None).cast("long")
    for column in categories:
        own = F.col("column") == column
        start = F.when(own, F.lit(first[column]).cast("long")).otherwise(start)
        width = F.when(own, F.lit(max(0, counts.get(column, 0) - (not keep_unseen))).cast("long")).otherwise(width)
    index = F.col("index").cast("long")
    slotted = levels.select("column", "value", F.when(index < width, start + index).cast("int").alias("slot"))
    numbered = {c: size + i for i, c in enumerate(numbers)}
    narrow = narrow_columns({c: counts.get(c, 0) for c in categories})
    return Slots(slotted, first, numbered, size + len(numbers), keep_unseen, narrow)


def slot_names(slots: Slots) -> DataFrame:
    """(slot, column, value): what every slot stands for; ``value`` is NULL for numbers."""
    rows = slots.levels.where("slot IS NOT NULL").select("slot", "column", "value")
    if not slots.numbers:
        return rows
    cells = [F.struct(F.lit(s).alias("slot"), F.lit(c).alias("column"), F.lit(None).cast("string").alias("value"))
             for c, s in slots.numbers.items()]
    return rows.unionAll(rows.sparkSession.range(1).select(F.inline(F.array(*cells))))


def _slot(slots: Slots, column: Column, text: Column, unseen: Column, slot: Column) -> Column:
    """A cell's slot; without ``keep_unseen`` a value that no training row had fails the job."""
    if slots.keep_unseen:
        return slot
    message = F.concat(F.lit("no such level in training: "), column, F.lit("="), F.coalesce(text, F.lit("NULL")))
    return F.when(unseen, F.raise_error(message).cast("int")).otherwise(slot)


def _rows(df: DataFrame, key: str, slots: Slots) -> DataFrame:
    """(key, own): the whole row, and the slots of its columns with few levels."""
    rows = df.select(F.col(key).alias("__key"), F.struct("*").alias("__row"))
    given = []
    for i, name in enumerate(slots.narrow):
        own = slots.levels.where(F.col("column") == name).select(
            F.col("value").cast("string").alias(f"__value_{i}"), F.col("slot").alias(f"__slot_{i}"))
        text, value = F.col("__row")[name].cast("string"), F.col(f"__value_{i}")
        rows = rows.join(F.broadcast(own), text == value, "left")
        given.append(_slot(slots, F.lit(name), text, value.isNull(), F.col(f"__slot_{i}")))
    known = F.array(*given).cast("array<int>")
    return rows.select("__key", F.struct(F.col("__row").alias("row"), known.alias("known")).alias("own"))


def _found(df: DataFrame, key: str, slots: Slots) -> DataFrame:
    """(key, own, slot): a row's other cells with their slots; the first carries the whole row.

    A cell without a slot has NULL.
    """
    rows = _rows(df, key, slots)
    names = [c for c in slots.first if c not in slots.narrow]
    if not names:
        return rows.withColumn("slot", F.lit(None).cast("int"))
    cells = [
        F.struct(
            (F.col("own") if i == 0 else F.lit(None)).alias("own"),
            F.lit(name).alias("column"),
            F.col("own")["row"][name].cast("string").alias("text"),
        )
        for i, name in enumerate(names)
    ]
    laid_out = rows.select("__key", F.inline(F.array(*cells)))
    levels = slots.levels.select(F.col("column").alias("__column"), F.col("value").alias("__value"), "slot")
    joined = laid_out.join(levels, (F.col("column") == F.col("__column")) & (F.col("text") == F.col("__value")), "left")
    slot = _slot(slots, F.col("column"), F.col("text"), F.col("__column").isNull(), F.col("slot"))
    return joined.select("__key", "own", slot.alias("slot"))


def _sparse(size: int, indices: Column, values: Column) -> Column:
    """A sparse vector from its parts, by way of the JSON form that Spark reads vectors from."""
    parts = F.struct(
        F.lit(0).alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values")
    )
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), _VECTOR)["v"]


def with_features(df: DataFrame, key: str, slots: Slots, name: str = "features") -> DataFrame:
    """Add a sparse vector to every row; ``key`` must tell the rows apart.

    Missing numbers fail the job, as in ``encode.feature_stages``; zeros take no
    place in the vector.  Values that belong to numbers must be finite.
    """
    grouped = _found(df, key, slots).groupBy("__key").agg(
        F.first("own", ignorenulls=True).alias("own"),
        F.count("own").alias("rows"),
        F.collect_list("slot").alias("slots"),
    )
    one = F.when(F.col("rows") == 1, F.col("own")).otherwise(
        F.raise_error(F.concat(F.lit("the key repeats: "), F.coalesce(F.col("__key").cast("string"), F.lit("NULL"))))
    )
    all_ = F.array_sort(F.concat("slots", F.filter(F.col("own")["known"], lambda s: s.isNotNull())))
    rows = grouped.select(one.alias("own"), all_.alias("slots")).select("own.row", "slots")
    given = [
        F.struct(F.lit(slot).alias("slot"), F.coalesce(F.col("row")[c].cast("double"), _missing(c)).alias("value"))
        for c, slot in slots.numbers.items()
    ]
    ones = F.transform("slots", lambda s: F.struct(s.alias("slot"), F.lit(1.0).alias("value")))
    numbers = F.filter(F.array(*given), lambda x: x["value"] != 0) if given else None
    filled = rows.select("row", (F.concat(ones, numbers) if given else ones).alias("filled"))
    vector = _sparse(
        slots.size, F.transform("filled", lambda x: x["slot"]), F.transform("filled", lambda x: x["value"])
    )
    return filled.select("row.*", vector.alias(name))


def _missing(column: str) -> Column:
    return F.raise_error(F.lit(f"missing number in {column}")).cast("double")


def vector_cells(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, slot, value): the filled slots of a sparse vector column, none of the empty ones."""
    parts = F.unwrap_udt(column)
    return df.select(key, F.explode(F.arrays_zip(parts["indices"].alias("slot"), parts["values"].alias("value"))).alias("x")).select(
        key, "x.slot", "x.value"
    )
