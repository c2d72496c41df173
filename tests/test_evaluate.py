"""Measures against plain Python and against the built-in evaluators."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tallymark.operators import evaluate


@pytest.fixture(scope="module")
def judged(spark):
    draw = random.Random(5)
    rows = [(float(draw.randrange(3)), float(draw.randrange(4))) for _ in range(500)]
    return spark.createDataFrame(rows, "label double, prediction double").cache()


@pytest.mark.parametrize(
    "ours, theirs",
    [
        ("weighted_true_positive_rate", "weightedTruePositiveRate"),
        ("weighted_false_positive_rate", "weightedFalsePositiveRate"),
        ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"),
        ("weighted_f_measure", "weightedFMeasure"),
    ],
)
def test_weighted_metrics(judged, ours, theirs):
    row = evaluate.weighted_metrics(judged, "label", "prediction").first()
    expected = MulticlassClassificationEvaluator(metricName=theirs).evaluate(judged)
    assert row[ours] == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize(
    "ours, theirs",
    [
        ("true_positive_rate", "truePositiveRateByLabel"),
        ("false_positive_rate", "falsePositiveRateByLabel"),
        ("precision", "precisionByLabel"),
        ("recall", "recallByLabel"),
        ("f_measure", "fMeasureByLabel"),
    ],
)
def test_metrics_by_label(judged, ours, theirs):
    for row in evaluate.metrics_by_label(judged, "label", "prediction", beta=2.0).collect():
        expected = MulticlassClassificationEvaluator(
            metricName=theirs, metricLabel=row.label, beta=2.0
        ).evaluate(judged)
        assert row[ours] == pytest.approx(expected, abs=1e-12)


def test_accuracy_and_confusion(judged):
    row = evaluate.accuracy(judged, "label", "prediction").first()
    expected = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(judged)
    assert row.accuracy == pytest.approx(expected) and row.test_error == pytest.approx(1 - expected)
    cells = evaluate.confusion(judged, "label", "prediction")
    assert cells.agg(F.sum("n")).first()[0] == 500
    wide = evaluate.confusion_table(judged, "label", "prediction", [0.0, 1.0, 2.0, 3.0])
    assert wide.count() == 3 and len(wide.columns) == 6


def test_one_class_only(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0)], "label double, prediction double")
    (row,) = evaluate.metrics_by_label(df, "label", "prediction").collect()
    assert (row.recall, row.precision, row.false_positive_rate) == (0.5, 1.0, None)


def test_regression_measures(spark):
    df = spark.createDataFrame(
        [(1.0, 1.5), (2.0, 1.5), (4.0, 4.5), (8.0, 6.0)], "label double, prediction double"
    )
    for name, ours in (("rmse", evaluate.rmse), ("r2", evaluate.r_squared)):
        expected = RegressionEvaluator(metricName=name).evaluate(df)
        assert ours(df, "label", "prediction").first()[0] == pytest.approx(expected)


def scored_rows():
    draw = random.Random(9)
    # A third of all rows share one score.
    return [
        (float(draw.random() < 0.3), 0.5 if draw.random() < 0.34 else round(draw.random(), 3))
        for _ in range(3000)
    ]


@pytest.fixture(scope="module", params=[1, 17])
def curve(spark, request):
    rows = scored_rows()
    df = spark.createDataFrame(rows, "label double, score double").repartition(request.param)
    return df, evaluate.operating_points(df, "label", "score"), rows


def brute_force(rows):
    positives = sum(label == 1 for label, _ in rows)
    negatives = len(rows) - positives
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(label == 1 and s >= t for label, s in rows)
        fp = sum(label != 1 and s >= t for label, s in rows)
        yield t, tp, fp, positives, negatives


def test_curves_match_brute_force(curve):
    _, points, rows = curve
    expected = list(brute_force(rows))
    roc = sorted((r.fpr, r.tpr) for r in evaluate.roc_curve(points).collect())
    assert roc == sorted([(0.0, 0.0), (1.0, 1.0)] + [(fp / n, tp / p) for _, tp, fp, p, n in expected])
    pr = sorted((r.recall, r.precision) for r in evaluate.pr_curve(points).collect())
    _, tp, fp, _, _ = expected[0]
    assert pr == sorted([(0.0, tp / (tp + fp))] + [(tp / p, tp / (tp + fp)) for _, tp, fp, p, _ in expected])
    by_threshold = {
        r.threshold: (r.precision, r.recall)
        for r in evaluate.precision_recall_by_threshold(points).collect()
    }
    assert by_threshold == {t: (tp / (tp + fp), tp / p) for t, tp, fp, p, _ in expected}


def test_best_threshold(curve):
    _, points, rows = curve
    f, t = max((2 * tp / (2 * tp + (p - tp) + fp), t) for t, tp, fp, p, _ in brute_force(rows))
    row = evaluate.best_threshold(points).first()
    assert (row.threshold, row.f_measure) == (t, pytest.approx(f))


def test_area_matches_the_built_in_evaluator(curve):
    df, points, _ = curve
    expected = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", metricName="areaUnderROC", numBins=0
    ).evaluate(df)
    assert evaluate.auc(points).first().auc == pytest.approx(expected, abs=1e-9)


def test_bins_bound_the_points(curve):
    df, _, _ = curve
    points = evaluate.operating_points(df, "label", "score", bin_width=0.1)
    assert points.count() <= 11
    assert points.agg(F.max("tp") == F.max("tp_all")).first()[0]
