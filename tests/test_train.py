"""Models: closed forms, metamorphic checks, save and load."""

import math

import pytest
from pyspark.ml.classification import NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallymark.operators import closed_form, encode, train
from tallymark.sources import sinks



@pytest.fixture(scope="module")
def two_classes(spark):
    """Class 1 lies above the diagonal, with some noise."""
    df = spark.range(400).select(
        "id",
        ((F.col("id") * 37) % 101 / 101.0).alias("a"),
        ((F.col("id") * 53) % 97 / 97.0).alias("b"),
    )
    label = ((F.col("a") + F.col("b") > 1) & (F.col("id") % 20 != 0)).cast("double")
    return df.withColumn("label", label).cache()


MODELS = [
    ("logistic", {"maxIter": 20}),
    ("logistic", {"maxIter": 20, "family": "multinomial"}),
    ("tree", {"maxDepth": 4, "seed": 1}),
    ("forest", {"numTrees": 5, "seed": 1}),
    ("boosted", {"maxIter": 3, "seed": 1}),
    ("perceptron", {"layers": [2, 4, 2], "maxIter": 60, "seed": 1}),
    ("svm", {"maxIter": 20}),
    ("bayes", {}),
]


@pytest.mark.parametrize("kind, params", MODELS)
def test_models_beat_the_majority_and_survive_saving(spark, two_classes, tmp_path, kind, params):
    stages = encode.feature_stages([], ["a", "b"])
    model = train.fit(two_classes, stages, train.estimator(kind, **params))
    scored = train.score(model, two_classes, ["id", "label"])
    assert scored.columns[:3] == ["id", "label", "prediction"]
    right = scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    zeros = two_classes.agg(F.avg(1 - F.col("label"))).first()[0]
    assert right >= max(zeros, 1 - zeros) - (0.05 if kind == "bayes" else 0)
    if "probability" in scored.columns:
        bad = scored.where(
            (F.array_min("probability") < 0) | (F.abs(F.col("probability")[0] + F.col("probability")[1] - 1) > 1e-9)
        )
        assert bad.count() == 0
    sinks.save_model(model, str(tmp_path / "model"))
    again = train.score(sinks.load_model(str(tmp_path / "model")), two_classes, ["id", "label"])
    assert sorted(map(str, again.collect())) == sorted(map(str, scored.collect()))


@pytest.mark.parametrize("partitions", [1, 17])
def test_linear_model_is_the_least_squares_line(spark, partitions):
    df = spark.range(100).select(
        F.col("id").cast("double").alias("x"), (3 + 2 * F.col("id") + F.sin("id")).alias("label")
    ).repartition(partitions)
    model = train.fit(df, encode.feature_stages([], ["x"]), train.estimator("linear"))
    found = dict(train.coefficients(model.stages[-1], ["x"]).collect())
    line = closed_form.simple_regression(df, "label", "x").first()
    assert found["intercept"] == pytest.approx(line.intercept, abs=1e-8)
    assert found["x"] == pytest.approx(line.slope, abs=1e-8)
    assert line.r2 > 0.99


def test_naive_bayes_closed_form_matches_the_fitted_model(spark):
    df = spark.createDataFrame(
        [(0.0, 0.1, 0.0, 0.0), (0.0, 0.5, 0.0, 1.0), (1.0, 1.0, 1.0, 0.0)],
        "label double, w double, a double, b double",
    )
    fitted = NaiveBayes(weightCol="w", smoothing=1.0).fit(
        VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    )
    ours = {
        (r.label, r.term): r.value
        for r in closed_form.naive_bayes(df, "label", ["a", "b"], "w").collect()
    }
    for c in (0, 1):
        assert ours[float(c), "pi"] == pytest.approx(fitted.pi[c])
        for j, name in enumerate("ab"):
            assert ours[float(c), name] == pytest.approx(fitted.theta.toArray()[c, j])
    assert ours[0.0, "a"] == pytest.approx(math.log(1 / 2.5))


def test_one_vs_rest_scores_like_the_library(spark):
    rows = [(i, float(i % 3), Vectors.dense([float(i % 3 == k) + (i % 7) / 10 for k in range(3)])) for i in range(90)]
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    model = train.fit_one_vs_rest(df, train.estimator("logistic", maxIter=10))
    ours = {r.id: r.prediction for r in train.score_one_vs_rest(model, df, ["id"]).collect()}
    theirs = {r.id: r.prediction for r in model.transform(df).collect()}
    assert ours == theirs
    total = train.score_one_vs_rest(model, df, ["id"]).select(
        F.aggregate("probability", F.lit(0.0), lambda a, p: a + p).alias("t")
    )
    assert total.where(F.abs(F.col("t") - 1) > 1e-9).count() == 0


def test_boosted_models_per_class(spark):
    rows = [(i, float(i % 4), Vectors.dense([float(i % 4 == k) for k in range(4)])) for i in range(80)]
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    model = train.fit_one_vs_rest(df, train.estimator("boosted", maxIter=2, maxDepth=2, seed=1))
    out = train.score_one_vs_rest(model, df, ["id", "label"])
    assert out.where("label = prediction").count() == 80


def test_cross_validation_measures_every_combination(two_classes):
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(two_classes)
    choices = {"regParam": [0.01, 100.0], "threshold": [0.5, 0.6]}
    best, measured = train.cross_validate(
        df, "id", train.estimator("logistic", maxIter=10), choices, folds=3
    )
    table = {r.params: r.measure for r in measured.collect()}
    assert len(table) == 4 and all(0 <= m <= 1 for m in table.values())
    assert best.getRegParam() == 0.01
    again = train.cross_validate(
        df.repartition(5), "id", train.estimator("logistic", maxIter=10), choices, folds=3
    )[1]
    assert {r.params: round(r.measure, 6) for r in again.collect()} == {
        k: round(v, 6) for k, v in table.items()
    }


def test_importances_follow_the_slot_names(two_classes):
    df = two_classes.withColumn("noise", F.lit(1.0))
    model = train.fit(df, encode.feature_stages([], ["a", "b", "noise"]), train.estimator("tree", seed=1))
    names = encode.slot_names(model.transform(df))
    found = dict(train.importances(model.stages[-1], names).collect())
    assert list(found) == ["a", "b", "noise"]
    assert found["noise"] == 0 and sum(found.values()) == pytest.approx(1)


def test_training_history_goes_down(two_classes):
    model = train.fit(two_classes, encode.feature_stages([], ["a", "b"]), train.estimator("logistic"))
    values = [r.objective for r in train.training_history(model.stages[-1]).orderBy("iteration").collect()]
    assert len(values) > 1 and values[-1] < values[0]


def test_blend_averages_the_scores(two_classes):
    stages = encode.feature_stages([], ["a", "b"])
    models = {
        "p": (train.fit(two_classes, stages, train.estimator("forest", numTrees=3, seed=1)), "probability"),
        "q": (train.fit(two_classes, stages, train.estimator("boosted_regression", maxIter=2, seed=1)), "prediction"),
    }
    out = train.blend(models, two_classes, ["id"])
    assert out.columns == ["id", "p", "q", "score"]
    assert out.where(F.abs(F.col("score") - (F.col("p") + F.col("q")) / 2) > 1e-12).count() == 0


def test_balanced_weights_give_both_classes_the_same_total(spark):
    df = spark.createDataFrame([(1,)] * 10 + [(0,)] * 90, "label int")
    out = closed_form.balanced_weights(df, "label").groupBy("label").agg(F.sum("weight").alias("w"))
    assert {r.label: round(r.w, 9) for r in out.collect()} == {0: 50.0, 1: 50.0}


def test_in_memory_fit_is_the_same_and_releases_the_table(two_classes):
    df = two_classes.select("id", "a", "b", "label").where("id >= 0")
    stages = encode.feature_stages([], ["a", "b"])
    models = [
        train.fit(df, stages, train.estimator("tree", seed=1), in_memory=kept) for kept in (True, False)
    ]
    assert not df.is_cached
    assert models[0].stages[-1].toDebugString.split("\n")[1:] == models[1].stages[-1].toDebugString.split("\n")[1:]


def test_threshold_moves_predictions(two_classes):
    stages = encode.feature_stages([], ["a", "b"])
    counts = []
    for threshold in (0.2, 0.8):
        model = train.fit(two_classes, stages, train.estimator("logistic", threshold=threshold))
        counts.append(train.score(model, two_classes, ["id"]).where("prediction = 1").count())
    assert counts[0] > counts[1]


def test_no_task_of_a_forest_has_too_many_rows(two_classes, monkeypatch):
    class Seen(RandomForestClassifier):
        def _fit(self, dataset):
            sizes.extend(r["count"] for r in dataset.groupBy(F.spark_partition_id()).count().collect())
            return super()._fit(dataset)

    sizes = []
    monkeypatch.setattr(train, "ENTRIES", 500, raising=False)
    rows = two_classes.coalesce(1)
    model = train.fit(rows, [VectorAssembler(inputCols=["a", "b"], outputCol="features")], Seen(numTrees=5, seed=1))
    assert sum(sizes) == 400 and max(sizes) <= 110
    assert model.transform(rows).where("prediction = label").count() > 360
