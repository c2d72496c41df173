"""What a fitted model goes by: permutation importance, and trees as tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import ordered, split
from tallymark.operators.tune import accuracy
from tallymark.session import reliable_copy, use_checkpoint_folder


def shuffled(df: DataFrame, key: str | Sequence[str], columns: Sequence[str], salt: str = "shuffle") -> DataFrame:
    """``df`` with a column ``name__shuffled`` for each named one: its values, dealt to other rows.

    Rows are ranked by a digest of their key, and a value goes as many ranks on as
    a digest of its column's name says, so no row keeps its own place and columns
    move by different steps.  The same rows give the same shuffle on every run.
    The key must be unique.  With fewer than two rows nothing can move.
    """
    names = [key] if isinstance(key, str) else list(key)
    drawn = df.withColumn("__draw", split.draw(key, salt))
    placed = ordered.running_sums(drawn, [F.asc("__draw"), *map(F.asc, names)], {"__place": F.lit(1)})
    rows = reliable_copy(placed.drop("__draw").withColumn("__place", F.col("__place") - 1))
    found = rows
    for name in columns:
        step = F.conv(F.substring(F.md5(F.lit(f"{salt}|{name}")), 1, 8), 16, 10).cast("long")
        moved = 1 + F.pmod(step, F.greatest(F.col("__place_all") - 1, F.lit(1)))
        values = rows.select(
            F.pmod(F.col("__place") + moved, F.col("__place_all")).alias("__place"), F.col(name).alias(f"{name}__shuffled")
        )
        found = found.join(values, "__place")
    return found.drop("__place", "__place_all")


def permutation_importance(
    score: Callable[[DataFrame], DataFrame],
    df: DataFrame,
    key: str | Sequence[str],
    columns: Sequence[str],
    label: str = "label",
    measure: Callable[[Column, Column], Column] = accuracy,
) -> DataFrame:
    """(feature, measure, loss): what the measure loses when a column is shuffled.

    ``score`` adds ``prediction`` to a table, for instance a fitted pipeline's
    ``transform``; so ``columns`` are those of the table, and a category is one
    feature however many slots its vector has.  The row ``feature IS NULL`` has the
    measure of the table as it is.  A column the model does not use loses exactly 0.
    """
    rows = reliable_copy(shuffled(df, key, columns))
    own = df.columns
    parts = []
    for name in [None, *columns]:
        cells = [F.col(f"{c}__shuffled").alias(c) if c == name else F.col(c) for c in own]
        scored = score(rows.select(*cells))
        parts.append(
            scored.agg(measure(F.col(label), F.col("prediction")).alias("measure")).select(
                F.lit(name).cast("string").alias("feature"), "measure"
            )
        )
    # One row per feature.
    found = reliable_copy(reduce(DataFrame.unionAll, parts))
    whole = found.where("feature IS NULL").select("measure").scalar()
    return found.select("feature", "measure", (whole - F.col("measure")).alias("loss"))


# Trees ----------------------------------------------------------------------------


def tree_table(model: Model, names: Sequence[str]) -> DataFrame:
    """(tree, node, parent, side, depth, feature, split, categories, prediction, impurity, gain, rows).

    One row per node of a fitted tree, forest or boosted model, read from the
    model's own files, so a large forest does not pass through Python.  ``names``
    are those of the vector slots.  A node sends rows with at most ``split``, or
    with one of ``categories``, to its ``left`` child; leaves have no feature.
    ``rows`` counts the training rows that arrived at the node, by the tree's own
    sample of them; the root's parent and side are NULL.
    """
    spark = SparkSession.active()
    use_checkpoint_folder(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    if "nodeData" in saved.columns:
        saved = saved.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        saved = saved.withColumn("tree", F.lit(0))
    nodes = reliable_copy(saved)
    sides = [F.struct(F.col(c).alias("id"), F.col("id").alias("parent"), F.lit(s).alias("side"))
             for c, s in (("leftChild", "left"), ("rightChild", "right"))]
    above = nodes.where("leftChild >= 0").select("tree", F.inline(F.array(*sides)))
    placed = nodes.join(above, ["tree", "id"], "left")
    leaf = F.col("leftChild") < 0
    feature = F.get(F.array(*[F.lit(n) for n in names]), F.col("split.featureIndex"))
    listed = F.col("split.leftCategoriesOrThreshold")
    numeric = F.col("split.numCategories") < 0
    return placed.join(_depths(nodes, above), ["tree", "id"]).select(
        "tree",
        F.col("id").alias("node"),
        "parent",
        "side",
        "depth",
        F.when(~leaf, feature).alias("feature"),
        F.when(~leaf & numeric, F.get(listed, F.lit(0))).alias("split"),
        F.when(~leaf & ~numeric, listed).alias("categories"),
        "prediction",
        "impurity",
        F.when(~leaf, F.col("gain")).alias("gain"),
        F.col("rawCount").alias("rows"),
    )


def _depths(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, id, depth): level by level from the roots; trees have 30 levels at most."""
    level = nodes.where("id = 0").select("tree", "id")
    levels = [level.withColumn("depth", F.lit(0))]
    steps = reliable_copy(above)
    while not (level := reliable_copy(
        steps.join(level.withColumnRenamed("id", "parent"), ["tree", "parent"]).select("tree", "id"))).isEmpty():
        levels.append(level.withColumn("depth", F.lit(len(levels))))
    return reduce(DataFrame.unionAll, levels)


# Optimality -----------------------------------------------------------------------


def logistic_gradient(
    scored: DataFrame, label: str, features: Sequence[str], weight: str | None = None
) -> DataFrame:
    """(term, gradient): slope of the mean logistic loss by each coefficient, one pass.

    ``scored`` has ``probability`` as an array.  Slopes are per standard deviation
    of the feature, so they compare.  Without a penalty they are 0 at the optimum
    where a coefficient is free, at least 0 at a lower bound and at most 0 at an
    upper one; the sums are weighted as the fit was.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    error = F.col("probability")[1] - F.col(label)
    slopes = [F.sum(w * error).alias("intercept")]
    slopes += [(F.sum(w * error * F.col(f)) / F.nullif(F.stddev_samp(f), F.lit(0.0))).alias(f) for f in features]
    sums = scored.agg(F.sum(w).alias("__weight"), *slopes)
    cells = [F.struct(F.lit(c).alias("term"), (F.col(c) / F.col("__weight")).alias("gradient")) for c in ("intercept", *features)]
    return sums.select(F.inline(F.array(*cells)))
