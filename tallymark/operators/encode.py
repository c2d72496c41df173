"""Turning text columns into indexes, indicator vectors and feature vectors.

Two routes give the same indexes.  ``feature_stages`` uses the ``pyspark.ml``
estimators, whose label lists live on the driver, and is for columns whose
number of levels has been checked.  ``level_index`` / ``apply_levels`` keep the
levels in a distributed table and have no such limit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations_with_replacement
from math import comb
from operator import mul

from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import (
    IndexToString,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.ordered import ranked
from tallymark.session import reliable_copy

MAX_LEVELS = 10_000  # label lists up to this length are fine on the driver


# Indexes as a table -------------------------------------------------------


def level_index(df: DataFrame, column: str, order: str = "frequency", by: str | None = None) -> DataFrame:
    """(value, index): every non-null value numbered 0, 1, 2, ...

    ``order`` is ``frequency`` (most frequent first, ties by value),
    ``alphabet`` (by value), or ``first_seen`` (smallest ``by`` first).
    """
    first, keys = _level_order(order, by)
    levels = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    numbered = ranked(levels.agg(first.alias("__first")), keys, "index")
    return numbered.select("value", F.col("index").cast("double").alias("index"))


def level_indexes(
    df: DataFrame, columns: Sequence[str], order: str = "frequency", by: str | None = None
) -> DataFrame:
    """(column, value, index) for several text columns, from one pass and one ranking."""
    first, keys = _level_order(order, by)
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
    )
    others = [by] if by else []
    levels = (
        df.select(*others, F.inline(cells))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(first.alias("__first"))
    )
    numbered = ranked(levels, keys, "index", group="column")
    return numbered.select("column", "value", F.col("index").cast("double").alias("index"))


def _level_order(order: str, by: str | None) -> tuple[Column, list[Column]]:
    if order == "frequency":
        return F.count(F.lit(1)), [F.desc("__first"), F.asc("value")]
    if order == "alphabet":
        return F.lit(0), [F.asc("value")]
    if order == "first_seen" and by is not None:
        return F.min(by), [F.asc("__first"), F.asc("value")]
    raise ValueError("order is frequency, alphabet, or first_seen with a column to go by")


def of_column(levels: DataFrame, column: str) -> DataFrame:
    """The levels of one column out of ``level_indexes``."""
    return levels.where(F.col("column") == column).select("value", "index")


def encode_columns(df: DataFrame, columns: Sequence[str], levels: DataFrame, keep: bool = False) -> DataFrame:
    """Replace several text columns by their indexes; values without one give NULL.

    With ``keep`` these share one extra index after all others of their column.
    The levels of columns that have few are broadcast, and the table is not
    shuffled for them: such levels hold large shares of the rows, which a join
    would put into a few tasks.  The cells of the other columns are laid out as
    (row, column, value), joined with the levels once, and regrouped by row.
    """
    counted = levels.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = dict.fromkeys(columns, 0) | {r["column"]: r["n"] for r in counted if r["column"] in columns}
    unseen = {c: F.lit(float(n)) if keep else F.lit(None).cast("double") for c, n in sizes.items()}
    narrow = narrow_columns(sizes)
    wide = [c for c in sizes if c not in narrow]
    encoded = _encode_narrow(df, narrow, levels, unseen) if narrow else df
    return _encode_long(encoded, wide, levels, unseen) if wide else encoded


def narrow_columns(sizes: Mapping[str, int]) -> list[str]:
    """The columns with the fewest levels, as many as have up to MAX_LEVELS altogether."""
    found, total = [], 0
    for column in sorted(sizes, key=lambda c: sizes[c]):
        total += sizes[column]
        if total > MAX_LEVELS:
            break
        found.append(column)
    return found


def _encode_narrow(df: DataFrame, columns: Sequence[str], levels: DataFrame, unseen: Mapping[str, Column]) -> DataFrame:
    rows = df.select(F.struct("*").alias("__row"))
    for i, column in enumerate(columns):
        own = of_column(levels, column).select(F.col("value").alias(f"__value_{i}"), F.col("index").alias(f"__index_{i}"))
        value = F.col("__row")[column].cast(own.schema[0].dataType)
        rows = rows.join(F.broadcast(own), value == F.col(f"__value_{i}"), "left").drop(f"__value_{i}")
    indexes = {c: F.coalesce(F.col(f"__index_{i}"), unseen[c]) for i, c in enumerate(columns)}
    return rows.select(*[indexes.get(c, F.col("__row")[c]).alias(c) for c in df.columns])


def _encode_long(df: DataFrame, columns: Sequence[str], levels: DataFrame, unseen: Mapping[str, Column]) -> DataFrame:
    kind = levels.schema["value"].dataType
    # The numbers of the rows must not change between attempts of a task.
    rows = reliable_copy(df.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("id")))
    cells = [
        F.struct(
            (F.col("row") if i == 0 else F.lit(None)).alias("row"),
            F.lit(c).alias("column"),
            F.col("row")[c].cast(kind).alias("value"),
        )
        for i, c in enumerate(columns)
    ]
    laid_out = rows.select("id", F.inline(F.array(*cells)))
    known = levels.select(F.col("column").alias("__column"), F.col("value").alias("__value"), "index")
    found = laid_out.join(known, (F.col("column") == F.col("__column")) & (F.col("value") == F.col("__value")), "left")
    names = {c: f"index_{i}" for i, c in enumerate(columns)}
    regrouped = found.groupBy("id").agg(
        F.first("row", ignorenulls=True).alias("row"),
        *[F.max(F.when(F.col("column") == c, F.col("index"))).alias(n) for c, n in names.items()],
    )
    indexes = {c: F.coalesce(F.col(n), unseen[c]) for c, n in names.items()}
    return regrouped.select(*[indexes.get(c, F.col("row")[c]).alias(c) for c in df.columns])


def apply_levels(df: DataFrame, column: str, levels: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Add the index of each value; values without one give NULL.

    With ``keep`` they share one extra index after all others.  The levels hold
    one row per value, so no row multiplies; a hot value is on the left side of
    the join, which the optimizer may split.
    """
    indexed = levels.select(F.col("value").alias("__value"), F.col("index").alias(name))
    joined = df.join(indexed, F.col(column) == F.col("__value"), "left").drop("__value")
    if keep:
        extra = levels.agg(F.count(F.lit(1)).cast("double")).scalar()
        joined = joined.withColumn(name, F.coalesce(name, extra))
    return joined


# Expansion ----------------------------------------------------------------


def monomials(columns: Sequence[str], degree: int, most: int = MAX_LEVELS) -> dict[str, Column]:
    """Name -> product, for all products of one to ``degree`` of the columns, repeats included.

    In order of degree, then of the columns: ``a``, ``b``, ``a*a``, ``a*b``, ``b*b``.
    A missing factor makes a missing product.  More than ``most`` products are
    refused, since every one becomes an expression of the plan.
    """
    if degree < 1:
        raise ValueError("degree must be positive")
    n = comb(len(columns) + degree, degree) - 1
    if n > most:
        raise ValueError(f"{n} products are too many")
    found = {}
    for d in range(1, degree + 1):
        for factors in combinations_with_replacement(columns, d):
            found["*".join(factors)] = reduce(mul, [F.col(c).cast("double") for c in factors])
    return found


def expand(df: DataFrame, columns: Sequence[str], degree: int) -> DataFrame:
    """Add a column for every product of two to ``degree`` of the columns."""
    added = {name: product for name, product in monomials(columns, degree).items() if name not in columns}
    return df.select("*", *[product.alias(name) for name, product in added.items()])


# Indexes and vectors through fitted pipelines ------------------------------


def level_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Approximate number of distinct values per column, from one pass."""
    counts = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in columns])
    return counts.first().asDict()


def usable_categories(
    df: DataFrame, columns: Sequence[str], limit: int = MAX_LEVELS, keep_unseen: bool = False
) -> list[str]:
    """The columns that can be encoded as indicators.

    A column with one level carries nothing and is left out; with
    ``keep_unseen`` missing values are a level, too.  One with more than
    ``limit`` levels is an id rather than a category and is refused.
    """
    found = level_counts(df, columns)
    if keep_unseen:
        gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
        found = {c: n + (gaps[c] > 0) for c, n in found.items()}
    too_many = [c for c in columns if found[c] > limit]
    if too_many:
        raise ValueError(f"too many levels for label lists, use sparse.fit_slots: {', '.join(too_many)}")
    return [c for c in columns if found[c] > 1]


def feature_stages(
    categories: Sequence[str],
    numbers: Sequence[str],
    keep_unseen: bool = False,
    numbers_first: bool = False,
    scaled: bool = False,
) -> list:
    """Pipeline stages that build ``features`` from text and number columns.

    Text columns are indexed by frequency and encoded without their last level.
    ``keep_unseen`` adds a level for unseen and missing values; without it such
    values fail the job.  ``scaled`` divides every slot by its deviation.
    """
    stages: list = []
    indexes = [f"{c}_index" for c in categories]
    vectors = [f"{c}_vec" for c in categories]
    invalid = "keep" if keep_unseen else "error"
    if categories:
        stages.append(
            StringIndexer(inputCols=list(categories), outputCols=indexes, handleInvalid=invalid)
        )
        stages.append(OneHotEncoder(inputCols=indexes, outputCols=vectors, dropLast=True))
    inputs = [*numbers, *vectors] if numbers_first else [*vectors, *numbers]
    assembled = "raw_features" if scaled else "features"
    stages.append(VectorAssembler(inputCols=inputs, outputCol=assembled, handleInvalid="error"))
    if scaled:
        stages.append(
            StandardScaler(inputCol=assembled, outputCol="features", withStd=True, withMean=False)
        )
    return stages


def fit_features(train: DataFrame, categories: Sequence[str], numbers: Sequence[str], **options) -> Transformer:
    """Fit the feature stages on the training table, for use on any table."""
    keep = options.get("keep_unseen", False)
    usable = usable_categories(train, categories, keep_unseen=keep) if categories else []
    return Pipeline(stages=feature_stages(usable, numbers, **options)).fit(train)


def fit_string_index(df: DataFrame, column: str, name: str, alphabetical: bool = False) -> StringIndexerModel:
    """Fit an index on one column whose number of levels has been checked."""
    if level_counts(df, [column])[column] > MAX_LEVELS:
        raise ValueError(f"too many levels in {column}: use level_index and apply_levels")
    order = "alphabetAsc" if alphabetical else "frequencyDesc"
    return StringIndexer(inputCol=column, outputCol=name, stringOrderType=order).fit(df)


def labels_back(model: StringIndexerModel, column: str, name: str) -> IndexToString:
    """The transformer that turns indexes back into the original values."""
    return IndexToString(inputCol=column, outputCol=name, labels=model.labels)


def fit_slot_categories(df: DataFrame, max_categories: int, column: str = "features", name: str = "indexed_features"):
    """Re-number vector slots that hold at most ``max_categories`` distinct values."""
    return VectorIndexer(
        inputCol=column, outputCol=name, maxCategories=max_categories, handleInvalid="keep"
    ).fit(df)


def vector_rows(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, slot, value): one row per slot of a vector column."""
    return df.select(key, F.posexplode(vector_to_array(column)).alias("slot", "value"))


def slot_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the slots of an assembled vector, in slot order."""
    attributes = df.schema[column].metadata["ml_attr"].get("attrs", {})
    found = {a["idx"]: a.get("name") for kind in attributes.values() for a in kind}
    return [found.get(i) or f"{column}_{i}" for i in range(slot_count(df, column))]


def slot_count(df: DataFrame, column: str = "features") -> int:
    """Length of an assembled vector."""
    return df.schema[column].metadata["ml_attr"]["num_attrs"]
