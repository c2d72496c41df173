"""Engine tests: clean, add list membership, choose a pass/fail model, score new tests.

    spark-submit tallymark/plans/engine_tests.py TRAIN TRAIN_LISTS TEST TEST_LISTS OUTPUT
"""

from __future__ import annotations

import sys
from collections.abc import Mapping
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IndexToString, StringIndexer, VectorIndexer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymark.functions import labels, text
from tallymark.operators import encode, evaluate, impute, relate, shape, split, train
from tallymark.sources import readers, schemas, sinks

SEED = 7
_COUNT = "Number_of_Cylinders"
# Categories of the model, and the two that are left out of it.
CATEGORIES = tuple(
    f.name
    for f in schemas.ENGINE_TESTS
    if f.name not in ("ID", "y", _COUNT, "Varaible_Valve_Timing_VVT", "main_bearing_type")
)
NUMBERS = (_COUNT, "test_results")

# Parameters and grids of the candidate models.
CANDIDATES: dict[str, tuple[dict[str, Any], dict[str, list]]] = {
    "forest": (
        {"seed": SEED},
        {"numTrees": [200, 100], "impurity": ["entropy"], "maxDepth": [30], "maxBins": [20, 10]},
    ),
    "logistic": ({"maxIter": 100}, {"regParam": [0.1, 0.01], "threshold": [0.6, 0.4]}),
    "boosted": ({"seed": SEED}, {"maxDepth": [30]}),
}
HIDDEN = (160, 150, 50, 10)
PERCEPTRON = {"maxIter": 200, "stepSize": 0.0003, "blockSize": 30, "tol": 1e-5, "seed": SEED}


def cylinder_mean(tests: DataFrame) -> DataFrame:
    """One row: the mean number of cylinders among tests that state it."""
    stated = tests.select(text.trimmed(_COUNT).try_cast("double").alias(_COUNT))
    return impute.means(stated, [_COUNT])


def prepared(tests: DataFrame, lists: DataFrame, mean: DataFrame) -> DataFrame:
    """One row per test: trimmed text, filled gaps, membership code, label if known.

    ``mean`` comes from the training table, for both tables.
    """
    words = [c for c in shape.text_columns(tests) if c not in (_COUNT, "y")]
    clean = shape.underscore_all(
        shape.missing_words_to_value(shape.trim_all(tests, words), "0", words), words
    )
    counted = clean.withColumn(_COUNT, text.trimmed(_COUNT).try_cast("double"))
    filled = shape.whole_numbers(impute.fill_from(counted, mean), [_COUNT])
    flags = relate.list_flags(lists, "TestA", "TestB", "ID")
    coded = relate.with_membership(filled.distinct(), "ID", flags)
    if "y" not in tests.columns:
        return coded
    return coded.withColumn("label", labels.binary_label("y", "pass").cast("double")).drop("y")


def featured(table: DataFrame, features: PipelineModel) -> DataFrame:
    known = [c for c in ("ID", "label") if c in table.columns]
    return features.transform(table).select(*known, "features")


def chosen(
    learn: DataFrame,
    holdout: DataFrame,
    candidates: Mapping[str, tuple[dict, dict]] = CANDIDATES,
    folds: int = 5,
) -> dict[str, tuple[Any, DataFrame, DataFrame]]:
    """Per candidate: best model of its grid, the grid's measures, hold-out accuracy."""
    found = {}
    for kind, (params, choices) in candidates.items():
        best, measured = train.cross_validate(
            learn, "ID", train.estimator(kind, **params), choices, folds=folds
        )
        scored = train.score(best, holdout, ["label"])
        found[kind] = (best, measured, evaluate.accuracy(scored, "label", "prediction"))
    return found


def perceptron(learn: DataFrame, hidden=HIDDEN, **params):
    """The network whose input layer is as long as the feature vector."""
    layers = train.perceptron_layers(encode.slot_count(learn), 2, hidden)
    return train.estimator("perceptron", layers=layers, **{**PERCEPTRON, **params}).fit(learn)


def indexed_logistic(learn: DataFrame, max_categories: int = 3) -> PipelineModel:
    """Label index, slot categories, logistic model, and predictions as original labels."""
    label_index = StringIndexer(inputCol="label", outputCol="indexed_label").fit(learn)
    slots = VectorIndexer(
        inputCol="features", outputCol="indexed_features", maxCategories=max_categories,
        handleInvalid="keep",
    )
    model = train.estimator("logistic", featuresCol="indexed_features", labelCol="indexed_label")
    back = IndexToString(
        inputCol="prediction", outputCol="predicted_label", labels=label_index.labels
    )
    with train.ready(learn) as rows:
        return Pipeline(stages=[label_index, slots, model, back]).fit(rows)


def curves(scored: DataFrame, label: str = "label") -> dict[str, DataFrame]:
    """Area under the curve and best threshold of a scored table.

    ``label`` must be the column the model was trained on: the more frequent
    original label is 0 in an indexed one.
    """
    points = evaluate.operating_points(
        scored.select(label, F.col("probability")[1].alias("score")), label, "score"
    )
    return {"auc": evaluate.auc(points), "best_threshold": evaluate.best_threshold(points)}


def run(
    spark: SparkSession, train_path: str, train_lists: str, test_path: str, test_lists: str,
    target: str, candidates: Mapping[str, tuple[dict, dict]] = CANDIDATES, folds: int = 5,
) -> None:
    """The whole job; every result is written below ``target``."""
    unlabelled = StructType([f for f in schemas.ENGINE_TESTS if f.name != "y"])
    raw = readers.csv(spark, train_path, schemas.ENGINE_TESTS)
    mean = cylinder_mean(raw)
    sinks.write_table(
        prepared(raw, readers.csv(spark, train_lists, schemas.ID_LISTS), mean), f"{target}/train"
    )
    sinks.write_table(
        prepared(
            readers.csv(spark, test_path, unlabelled),
            readers.csv(spark, test_lists, schemas.ID_LISTS),
            mean,
        ),
        f"{target}/test",
    )
    known, new = spark.read.parquet(f"{target}/train"), spark.read.parquet(f"{target}/test")
    learn, holdout = split.split(known, "ID", [0.8, 0.2])
    features = encode.fit_features(learn, CATEGORIES, NUMBERS, keep_unseen=True, numbers_first=True)
    found = chosen(featured(learn, features), featured(holdout, features), candidates, folds)
    for kind, (_, measured, accuracy) in found.items():
        sinks.write_csv(measured, f"{target}/{kind}/grid")
        sinks.write_csv(accuracy, f"{target}/{kind}/accuracy")
    best = found["forest"][0]
    sinks.save_model(PipelineModel([*features.stages, best]), f"{target}/model")
    scored = train.score(best, featured(new, features), ["ID"])
    sinks.write_table(scored, f"{target}/scored")
    sinks.write_csv(
        sinks.submission(spark.read.parquet(f"{target}/scored"), "ID"), f"{target}/submission"
    )


if __name__ == "__main__":
    run(SparkSession.builder.appName("engine tests").getOrCreate(), *sys.argv[1:6])
