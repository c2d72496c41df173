"""Hazard scores: first-seen encoding, a forest and a boosted model, their average.

    spark-submit tallymark/plans/hazard.py TRAIN.csv TEST.csv OUTPUT_FOLDER
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import encode, shape, train
from tallymark.sources import readers, sinks

# Parameters of the two models.
FOREST = {"numTrees": 25, "maxDepth": 30, "seed": 1}
BOOSTED = {
    "stepSize": 0.3, "maxDepth": 5, "minInstancesPerNode": 3, "subsamplingRate": 0.7,
    "featureSubsetStrategy": "0.7", "maxIter": 250, "seed": 1,
}


def encoded(known: DataFrame, new: DataFrame, key: str = "Id") -> tuple[DataFrame, DataFrame]:
    """Text columns as numbers in the order the training table first shows them.

    Values that only the new table has share one further number.
    """
    words = shape.text_columns(known)
    if not words:
        return known, new
    levels = encode.level_indexes(known, words, "first_seen", by=key)
    return tuple(encode.encode_columns(t, words, levels, keep=True) for t in (known, new))


def scored(
    known: DataFrame, new: DataFrame, key: str = "Id", target: str = "Hazard",
    forest: dict = FOREST, boosted: dict = BOOSTED,
) -> DataFrame:
    """(key, forest_score, boosted_score, score) for the new rows."""
    known, new = encoded(known, new, key)
    features = [c for c in known.columns if c not in (key, target)]
    classes = encode.level_index(known, target, "alphabet")
    labelled = encode.apply_levels(known, target, classes, "label")
    stages = encode.feature_stages([], features)
    models = {
        "forest_score": (
            train.fit(labelled, stages, train.estimator("forest", **forest)),
            "probability",
        ),
        "boosted_score": (
            train.fit(
                labelled, stages, train.estimator("boosted_regression", labelCol=target, **boosted)
            ),
            "prediction",
        ),
    }
    return train.blend(models, new, [key])


def run(spark: SparkSession, train_path: str, test_path: str, target: str, **sizes) -> None:
    """Read both files and write (id, Hazard) as CSV."""
    result = scored(readers.csv(spark, train_path), readers.csv(spark, test_path), **sizes)
    sinks.write_csv(
        result.select(F.col("Id").alias("id"), F.col("score").alias("Hazard")), f"{target}/result"
    )


if __name__ == "__main__":
    run(SparkSession.builder.appName("hazard").getOrCreate(), *sys.argv[1:4])
