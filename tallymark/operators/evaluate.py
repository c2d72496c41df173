"""Measuring scored tables: every measure is an aggregate, given as a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.ordered import running_sums

# Numbers ------------------------------------------------------------------


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: root of the mean squared error."""
    error = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def r_squared(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: share of the label's variance that the prediction explains.

    Rows without a label or a prediction are left out (``unpredicted`` counts
    them); NULL when the labels of the others are all equal.
    """
    known = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    error = F.col(label) - F.col(prediction)
    spread = F.nullif(F.var_pop(label) * F.count(label), F.lit(0.0))
    return known.agg((1 - F.sum(error * error) / spread).alias("r2"))


def unpredicted(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: how many labelled rows have no prediction, and how many no label."""
    return df.agg(
        F.count_if(F.col(label).isNotNull() & F.col(prediction).isNull()).alias("n_unpredicted"),
        F.count_if(F.col(label).isNull()).alias("n_unlabelled"),
    )


# Classes ------------------------------------------------------------------


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n): at most classes x classes rows."""
    return df.groupBy(
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_table(df: DataFrame, label: str, prediction: str, classes: list[float]) -> DataFrame:
    """One row per label with a count column per listed class, and ``other``.

    ``other`` counts the rows whose prediction is missing or not listed.
    """
    cells = confusion(df, label, prediction)
    listed = F.coalesce(F.col("prediction").isin(list(classes)), F.lit(False))
    counts = [
        F.coalesce(F.sum(F.when(F.col("prediction") == c, F.col("n"))), F.lit(0)).alias(str(c))
        for c in classes
    ]
    other = F.coalesce(F.sum(F.when(~listed, F.col("n"))), F.lit(0)).alias("other")
    return cells.groupBy("label").agg(*counts, other)


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: share of labelled rows predicted right, and the rest.

    A row without a prediction is not right.
    """
    same = F.coalesce(F.col(label) == F.col(prediction), F.lit(False)).cast("double")
    right = F.avg(F.when(F.col(label).isNotNull(), same))
    return df.agg(right.alias("accuracy")).withColumn("test_error", 1 - F.col("accuracy"))


def f_measure(hits: Column, misses: Column, false_alarms: Column, beta: float) -> Column:
    """F-measure from counts; 0 where nothing was found."""
    square = beta * beta
    found = (1 + square) * hits
    return F.when(hits > 0, found / (found + square * misses + false_alarms)).otherwise(0.0)


def metrics_by_label(df: DataFrame, label: str, prediction: str, beta: float = 1.0) -> DataFrame:
    """One row per label that occurs: rates, precision, recall, F-measure.

    Everything comes from the small confusion counts, so the table is read and
    shuffled once.  ``false_positive_rate`` is NULL when no row has another label.
    """
    cells = F.array(
        F.struct(
            F.col("label"),
            F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
            F.col("n").alias("actual"),
            F.lit(0).cast("bigint").alias("predicted"),
        ),
        F.struct(
            F.col("prediction").alias("label"),
            F.lit(0).cast("bigint").alias("hits"),
            F.lit(0).cast("bigint").alias("actual"),
            F.col("n").alias("predicted"),
        ),
    )
    counts = confusion(df, label, prediction)
    total = counts.agg(F.sum("n")).scalar()
    per_label = (
        counts.select(F.inline(cells))
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("hits", "actual", "predicted")])
        .where(F.col("actual") > 0)
        .withColumn("total", total)
    )
    hits, actual, predicted = F.col("hits"), F.col("actual"), F.col("predicted")
    false_alarms = predicted - hits
    others = F.col("total") - actual
    recall = hits / actual
    return per_label.select(
        "label",
        "actual",
        "total",
        recall.alias("true_positive_rate"),
        F.when(others > 0, false_alarms / others).alias("false_positive_rate"),
        F.when(predicted > 0, hits / predicted).otherwise(0.0).alias("precision"),
        recall.alias("recall"),
        f_measure(hits, actual - hits, false_alarms, beta).alias("f_measure"),
    )


def weighted_metrics(df: DataFrame, label: str, prediction: str, beta: float = 1.0) -> DataFrame:
    """One row: the per-label measures averaged with the label shares as weights."""
    share = F.col("actual") / F.col("total")
    names = ("true_positive_rate", "false_positive_rate", "precision", "recall", "f_measure")
    return metrics_by_label(df, label, prediction, beta).agg(
        *[F.sum(F.col(n) * share).alias(f"weighted_{n}") for n in names]
    )


# Curves over thresholds ---------------------------------------------------


def binned(score: str, width: float) -> Column:
    """The score rounded down to a multiple of ``width``."""
    return F.floor(F.col(score) / width) * width


def operating_points(df: DataFrame, label: str, score: str, bin_width: float | None = None) -> DataFrame:
    """One row per distinct score: what happens when it is the threshold.

    ``tp`` and ``fp`` count positive (label 1) and other rows at or above the
    threshold, ``tp_all`` and ``fp_all`` all of them.  Rows are reduced to one
    per score before anything is ordered, and the ordering is spread over
    ranges.  ``bin_width`` bounds the number of points when a reading of every
    distinct score is not needed.  Rows without a label or a score are left out.
    """
    threshold = binned(score, bin_width) if bin_width else F.col(score)
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    points = known.groupBy(threshold.cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    sums = {"tp": F.col("pos"), "fp": F.col("neg")}
    return running_sums(points, [F.desc("threshold")], sums)


def _rate(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


def _precision() -> Column:
    return F.col("tp") / (F.col("tp") + F.col("fp"))


def roc_curve(points: DataFrame) -> DataFrame:
    """(fpr, tpr) per threshold, with both ends of the curve."""
    curve = points.select(_rate("fp", "fp_all").alias("fpr"), _rate("tp", "tp_all").alias("tpr"))
    ends = points.sparkSession.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "fpr double, tpr double")
    return ends.unionByName(curve)


def auc(points: DataFrame) -> DataFrame:
    """One row: area under the ROC curve by the trapezoid rule; NULL for one class.

    A step from the previous point is ``neg`` wide and its mean height is
    ``tp - pos / 2``, so no row needs to see its neighbour.
    """
    area = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2))
    whole = F.max("tp_all").cast("double") * F.max("fp_all")
    return points.agg((area / F.nullif(whole, F.lit(0.0))).alias("auc"))


def pr_curve(points: DataFrame) -> DataFrame:
    """(recall, precision) per threshold.

    The first point has recall 0 and the precision of the highest threshold.
    """
    curve = points.select(_rate("tp", "tp_all").alias("recall"), _precision().alias("precision"))
    first = points.agg(F.max_by(_precision(), "threshold").alias("precision")).select(
        F.lit(0.0).alias("recall"), "precision"
    )
    return first.unionByName(curve)


def precision_recall_by_threshold(points: DataFrame) -> DataFrame:
    return points.select(
        "threshold", _precision().alias("precision"), _rate("tp", "tp_all").alias("recall")
    )


def f_by_threshold(points: DataFrame, beta: float = 1.0) -> DataFrame:
    misses = F.col("tp_all") - F.col("tp")
    return points.select(
        "threshold", f_measure(F.col("tp"), misses, F.col("fp"), beta).alias("f_measure")
    )


def best_threshold(points: DataFrame, beta: float = 1.0) -> DataFrame:
    """One row: the largest F-measure and the (highest) threshold that gives it."""
    best = F.max(F.struct("f_measure", "threshold"))
    return (
        f_by_threshold(points, beta)
        .agg(best.alias("best"))
        .select("best.threshold", "best.f_measure")
    )
