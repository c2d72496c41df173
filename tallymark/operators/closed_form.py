"""Models whose parameters are plain aggregates: one pass, no iteration."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.labels import best_class, softmax


def simple_regression(df: DataFrame, label: str, feature: str) -> DataFrame:
    """One row: intercept, slope and r2 of the least-squares line."""
    return df.agg(
        F.regr_intercept(label, feature).alias("intercept"),
        F.regr_slope(label, feature).alias("slope"),
        F.regr_r2(label, feature).alias("r2"),
    )


def naive_bayes(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    weight: str | None = None,
    smoothing: float = 1.0,
) -> DataFrame:
    """(label, term, value): log class prior (term ``pi``) and log feature shares.

    The multinomial model over non-negative features.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    sums = df.groupBy(F.col(label).alias("label")).agg(
        F.sum(w).alias("__weight"), *[F.sum(w * F.col(f)).alias(f) for f in features]
    )
    # One row per class here, so this window is tiny; a scalar subquery would
    # need other sums than these and read the table again.
    classes = Window.partitionBy()
    everything = F.log(
        F.sum("__weight").over(classes) + F.count(F.lit(1)).over(classes) * F.lit(smoothing)
    )
    mass = sum((F.col(f) for f in features), F.lit(0.0)) + F.lit(len(features) * smoothing)
    terms = [("pi", F.log(F.col("__weight") + smoothing) - everything)]
    terms += [(f, F.log(F.col(f) + smoothing) - F.log(mass)) for f in features]
    cells = [F.struct(F.lit(n).alias("term"), value.alias("value")) for n, value in terms]
    return sums.select("label", F.array(*cells).alias("cells")).select(
        "label", F.inline("cells")
    )


def bernoulli_bayes(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    weight: str | None = None,
    smoothing: float = 1.0,
) -> DataFrame:
    """(label, term, present, value): log class prior (term ``pi``) and log chances of features.

    The model of features that are there (1) or not (0): a feature has a row for
    either, since its absence speaks, too.  Any other value fails the job.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    there = [
        F.sum(w * F.when(F.col(f).isin(0, 1), F.col(f)).otherwise(
            F.raise_error(F.lit(f"{f} is neither 0 nor 1")).cast("double"))).alias(f)
        for f in features
    ]
    sums = df.groupBy(F.col(label).alias("label")).agg(F.sum(w).alias("__weight"), *there)
    # One row per class here, so this window is tiny.
    classes = Window.partitionBy()
    everything = F.log(F.sum("__weight").over(classes) + F.count(F.lit(1)).over(classes) * F.lit(smoothing))
    mass = F.log(F.col("__weight") + 2 * smoothing)
    none = F.lit(None).cast("boolean")
    cells = [F.struct(F.lit("pi").alias("term"), none.alias("present"), (F.log(F.col("__weight") + smoothing) - everything).alias("value"))]
    for f in features:
        for present, count in ((True, F.col(f)), (False, F.col("__weight") - F.col(f))):
            chance = F.log(count + smoothing) - mass
            cells.append(F.struct(F.lit(f).alias("term"), F.lit(present).alias("present"), chance.alias("value")))
    return sums.select("label", F.array(*cells).alias("cells")).select("label", F.inline("cells"))


def score_bernoulli(model: DataFrame, df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Kept columns, ``prediction`` and ``probability`` (an array, classes in order of their label).

    A class starts from its prior and the absence of everything; every feature
    that is there adds the difference it makes.  The model has a few rows per
    class and reaches the table as one scalar.
    """
    absent = F.sum(F.when(F.col("term") == "pi", F.col("value")).when(~F.col("present"), F.col("value")))
    chances = [
        F.sum(F.when(F.col("term") == f, F.when(F.col("present"), F.col("value")).otherwise(-F.col("value")))).alias(f"f{i}")
        for i, f in enumerate(features)
    ]
    per_class = model.groupBy(F.col("label").cast("double").alias("label")).agg(absent.alias("absent"), *chances)
    differences = F.array(*[F.col(f"f{i}") for i in range(len(features))])
    classes = per_class.select(F.struct("label", "absent", differences.alias("differences")).alias("class"))
    listed = classes.agg(F.array_sort(F.collect_list("class")).alias("classes")).scalar()
    values = F.array(*[F.col(f).cast("double") for f in features])
    rows = df.select(*keep, values.alias("values"), listed.alias("classes"))
    evidence = F.transform(
        "classes",
        lambda c: c["absent"] + F.aggregate(
            F.zip_with("values", c["differences"], lambda x, d: x * d), F.lit(0.0), lambda a, x: a + x),
    )
    scored = rows.select(*keep, "classes", evidence.alias("evidence"))
    best = F.get("classes", best_class(F.col("evidence")).cast("int"))["label"]
    return scored.select(*keep, best.alias("prediction"), softmax(F.col("evidence")).alias("probability"))


def linear_regression(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """(term, value, std_error, t_value) of the least-squares plane, and rows for ``r2`` and ``n``.

    One pass: means and covariances of all pairs of columns, which merge without
    losing digits to large means.  The driver solves a system of the size of the
    features.  Rows with a missing value are left out.  Features that follow from
    others get the shortest solution and no errors.
    """
    names = [label, *features]
    known = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)]).dropna("any")
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = known.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(names))],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    schema = "term string, value double, std_error double, t_value double"
    n, k = sums["n"], len(features)
    if n == 0:
        return df.sparkSession.createDataFrame([("n", 0.0, None, None)], schema)
    spread = np.zeros((k + 1, k + 1))
    for i, j in pairs:
        spread[i, j] = spread[j, i] = sums[f"c{i}_{j}"]
    means = np.array([sums[f"m{i}"] for i in range(k + 1)])
    gram, moment = spread[1:, 1:], spread[1:, 0]
    scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    solved, _, rank, _ = np.linalg.lstsq(gram / np.outer(scale, scale), moment / scale, rcond=1e-10)
    slopes = solved / scale
    intercept = means[0] - slopes @ means[1:]
    left = max(0.0, float(spread[0, 0] - slopes @ moment))
    errors = [None] * (k + 1)
    if rank == k and n > k + 1:
        inverse = np.linalg.inv(gram / np.outer(scale, scale)) / np.outer(scale, scale)
        noise = float(left) * n / (n - k - 1)
        errors = [
            math.sqrt(noise / n * (1 + means[1:] @ inverse @ means[1:])),
            *np.sqrt(noise / n * np.diag(inverse)).tolist(),
        ]
    values = [float(intercept), *map(float, slopes)]
    rows = [
        (term, value, error, value / error if error else None)
        for term, value, error in zip(["intercept", *features], values, errors)
    ]
    r2 = float(1 - left / spread[0, 0]) if spread[0, 0] > 0 else None
    rows += [("r2", r2, None, None), ("n", float(n), None, None)]
    return df.sparkSession.createDataFrame(rows, schema)


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add row weights that give both classes of a 0/1 label the same total."""
    share = df.agg(F.avg(F.col(label).cast("double"))).scalar()
    return df.withColumn(
        name, F.when(F.col(label) == 1, 0.5 / share).otherwise(0.5 / (1 - share))
    )
