"""Measures over scored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions import labels
from tallymark.operators import evaluate
from tallymark.sources import sinks
from tallymark.sources.readers import table


def _rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def _priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a price predicted as quantity times the mean unit price."""
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    unit_price = lines.agg(F.sum("l_extendedprice") / F.sum("l_quantity")).scalar()
    return lines.withColumn("prediction", F.col("l_quantity") * unit_price)


def rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _priced_lines(spark, sf_dir)
    return _rounded(evaluate.rmse(lines, "l_extendedprice", "prediction"), "rmse", places=4)


def r_squared(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _priced_lines(spark, sf_dir)
    return _rounded(evaluate.r_squared(lines, "l_extendedprice", "prediction"), "r2")


def _judged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.col("quality").alias("label"), F.col("toxic").alias("prediction")
    )


def _judged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three status classes against a rule on the price."""
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.when(status == "F", 0).when(status == "O", 1).otherwise(2).alias("label"),
        F.when(price < 150000, 0).when(price < 350000, 1).otherwise(2).alias("prediction"),
    )


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion(_judged_documents(spark, sf_dir), "label", "prediction")


def confusion_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = _judged_orders(spark, sf_dir)
    wide = evaluate.confusion_table(judged, "label", "prediction", [0.0, 1.0, 2.0]).drop("other")
    return wide.toDF("label", "predicted_0", "predicted_1", "predicted_2")


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = evaluate.accuracy(_judged_orders(spark, sf_dir), "label", "prediction")
    return _rounded(measured, "accuracy", "test_error")


_RATES = ("true_positive_rate", "false_positive_rate", "precision", "recall", "f_measure")


def metrics_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = evaluate.metrics_by_label(_judged_orders(spark, sf_dir), "label", "prediction")
    return _rounded(measured, *_RATES)


def weighted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = evaluate.weighted_metrics(
        _judged_orders(spark, sf_dir), "label", "prediction", beta=2.0
    )
    return _rounded(measured, *[f"weighted_{r}" for r in _RATES])


def _points(spark: SparkSession, sf_dir: str, bin_width: float | None = None) -> DataFrame:
    """Purchases ranked by the value of the event."""
    events = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label"), "value"
    )
    return evaluate.operating_points(events, "label", "value", bin_width)


def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.roc_curve(_points(spark, sf_dir)), "fpr", "tpr")


def roc_curve_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.roc_curve(_points(spark, sf_dir, 0.5)), "fpr", "tpr")


def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.auc(_points(spark, sf_dir)), "auc")


def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.pr_curve(_points(spark, sf_dir)), "recall", "precision")


def f_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.f_by_threshold(_points(spark, sf_dir), beta=0.5), "f_measure")


def precision_recall_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = evaluate.precision_recall_by_threshold(_points(spark, sf_dir))
    return _rounded(curve, "precision", "recall")


def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.best_threshold(_points(spark, sf_dir)), "f_measure")


def apply_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = labels.threshold_of((0.6, 0.4))
    probability = F.least(F.col("value") / 100, F.lit(1.0))
    return table(spark, sf_dir, "events").select(
        "event_id", labels.above(probability, cut).alias("prediction")
    )


def argmax_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", labels.best_class(F.col("embedding")).alias("prediction")
    )


def _scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") / 1000000).alias("first_score"),
        (F.col("o_custkey") / 100000).alias("second_score"),
    )


def average_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored_orders(spark, sf_dir)
    return scored.select(
        "o_orderkey", F.round(labels.mean_of(["first_score", "second_score"]), 10).alias("score")
    )


def submission_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored_orders(spark, sf_dir)
    predicted = scored.withColumn("prediction", labels.above(F.col("first_score"), 0.25))
    return sinks.submission(predicted, "o_orderkey")


QUERIES = {
    "rmse": rmse,
    "r_squared": r_squared,
    "confusion_matrix": confusion_matrix,
    "confusion_wide": confusion_wide,
    "accuracy": accuracy,
    "metrics_by_label": metrics_by_label,
    "weighted_metrics": weighted_metrics,
    "roc_curve": roc_curve,
    "roc_curve_binned": roc_curve_binned,
    "auc": auc,
    "pr_curve": pr_curve,
    "f_by_threshold": f_by_threshold,
    "precision_recall_by_threshold": precision_recall_by_threshold,
    "best_threshold": best_threshold,
    "apply_threshold": apply_threshold,
    "argmax_label": argmax_label,
    "average_ensemble": average_ensemble,
    "submission_rows": submission_rows,
}

_LINES = """
    (SELECT l_extendedprice AS y,
            l_quantity * (SELECT sum(l_extendedprice) / sum(l_quantity) FROM lineitem) AS p
     FROM lineitem)"""
_JUDGED = """
    (SELECT CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS label,
            CASE WHEN o_totalprice < 150000 THEN 0 WHEN o_totalprice < 350000 THEN 1
                 ELSE 2 END AS prediction
     FROM orders)"""


def _by_label(beta: float) -> str:
    square = beta * beta
    return f"""
    (WITH j AS {_JUDGED},
     l AS (SELECT label, count(*) AS actual, (SELECT count(*) FROM j) AS total,
                  count(*) FILTER (label = prediction) AS hits FROM j GROUP BY label),
     p AS (SELECT prediction, count(*) AS predicted FROM j GROUP BY prediction)
     SELECT CAST(label AS DOUBLE) AS label, actual, total,
            hits / actual AS true_positive_rate,
            (coalesce(predicted, 0) - hits) / (total - actual) AS false_positive_rate,
            CASE WHEN predicted > 0 THEN hits / predicted ELSE 0.0::DOUBLE END AS precision,
            hits / actual AS recall,
            CASE WHEN hits > 0 THEN {1 + square}::DOUBLE * hits
                 / ({1 + square}::DOUBLE * hits + {square}::DOUBLE * (actual - hits)
                    + coalesce(predicted, 0) - hits)
                 ELSE 0.0::DOUBLE END AS f_measure
     FROM l LEFT JOIN p ON label = prediction)"""


def _points_sql(threshold: str = "value") -> str:
    return f"""
    (SELECT threshold, pos, neg,
            CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
            CAST(sum(pos) OVER () AS DOUBLE) AS p, CAST(sum(neg) OVER () AS DOUBLE) AS n
     FROM (SELECT {threshold} AS threshold, count(*) FILTER (event_type = 'purchase') AS pos,
                  count(*) FILTER (event_type <> 'purchase') AS neg
           FROM events GROUP BY 1)
     WINDOW w AS (ORDER BY threshold DESC))"""


def _roc_sql(points: str) -> str:
    return f"""
        SELECT 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
        UNION ALL SELECT 1.0::DOUBLE, 1.0::DOUBLE
        UNION ALL SELECT round(fp / n, 6), round(tp / p, 6) FROM {points}"""


_POINTS = _points_sql()

ORACLES = {
    "rmse": f"SELECT round(sqrt(avg((y - p) * (y - p))), 4) AS rmse FROM {_LINES}",
    "r_squared": f"""
        SELECT round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 6) AS r2
        FROM (SELECT y, p, avg(y) OVER () AS m FROM {_LINES})""",
    "confusion_matrix": """
        SELECT CAST(quality AS DOUBLE) AS label, CAST(toxic AS DOUBLE) AS prediction,
               count(*) AS n
        FROM labels GROUP BY quality, toxic""",
    "confusion_wide": f"""
        SELECT CAST(label AS DOUBLE) AS label,
               count(*) FILTER (prediction = 0) AS predicted_0,
               count(*) FILTER (prediction = 1) AS predicted_1,
               count(*) FILTER (prediction = 2) AS predicted_2
        FROM {_JUDGED} GROUP BY label""",
    "accuracy": f"""
        SELECT round(a, 6) AS accuracy, round(1 - a, 6) AS test_error
        FROM (SELECT avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END) AS a
              FROM {_JUDGED})""",
    "metrics_by_label": f"""
        SELECT label, actual, total, {', '.join(f'round({r}, 6) AS {r}' for r in _RATES)}
        FROM {_by_label(1.0)}""",
    "weighted_metrics": f"""
        SELECT {', '.join(f'round(sum({r} * actual / total), 6) AS weighted_{r}' for r in _RATES)}
        FROM {_by_label(2.0)}""",
    "roc_curve": _roc_sql(_POINTS),
    "roc_curve_binned": _roc_sql(_points_sql("floor(value / 0.5) * 0.5")),
    "auc": f"""
        SELECT round(sum(neg * (tp - pos / 2)) / (max(p) * max(n)), 6) AS auc FROM {_POINTS}""",
    "pr_curve": f"""
        SELECT round(tp / p, 6) AS recall, round(tp / (tp + fp), 6) AS precision FROM {_POINTS}
        UNION ALL (SELECT 0.0::DOUBLE, round(tp / (tp + fp), 6) FROM {_POINTS}
                   ORDER BY threshold DESC LIMIT 1)""",
    "f_by_threshold": f"""
        SELECT threshold, round(CASE WHEN tp > 0 THEN 1.25::DOUBLE * tp
               / (1.25::DOUBLE * tp + 0.25::DOUBLE * (p - tp) + fp) ELSE 0 END, 6) AS f_measure
        FROM {_POINTS}""",
    "precision_recall_by_threshold": f"""
        SELECT threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall
        FROM {_POINTS}""",
    "best_threshold": f"""
        SELECT threshold, round(f, 6) AS f_measure
        FROM (SELECT threshold, 2 * tp / (2 * tp + (p - tp) + fp) AS f FROM {_POINTS})
        ORDER BY f DESC, threshold DESC LIMIT 1""",
    "apply_threshold": """
        SELECT event_id,
               CASE WHEN least(value / 100, 1.0::DOUBLE)
                         > 1.0::DOUBLE / (1.0::DOUBLE + 0.6::DOUBLE / 0.4::DOUBLE)
                    THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
        FROM events""",
    "argmax_label": """
        SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS DOUBLE)
               AS prediction
        FROM embeddings""",
    "average_ensemble": """
        SELECT o_orderkey, round((o_totalprice / 1000000 + o_custkey / 100000) / 2, 10) AS score
        FROM orders""",
    "submission_rows": """
        SELECT o_orderkey AS "ID",
               CASE WHEN o_totalprice / 1000000 > 0.25::DOUBLE THEN 'pass' ELSE 'fail' END AS y
        FROM orders""",
}
