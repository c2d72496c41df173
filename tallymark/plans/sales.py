"""Retail sales: clean the rows, encode categories, fit a linear model, measure it.

    spark-submit tallymark/plans/sales.py INPUT.csv OUTPUT_FOLDER
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tallymark.operators import encode, evaluate, impute, shape, split, train
from tallymark.sources import readers, schemas, sinks

# The columns of the short and of the long model.
SHORT = (
    ("day_of_week", "promo", "state_holiday", "school_holiday", "month", "year", "store_type",
     "assortment_level"),
    ("competitor_distance", "competitor_months"),
)
LONG = (
    (*SHORT[0], "next_day_state_holiday", "next_day_school_holiday"),
    (*SHORT[1], "customer_count", "avg_sales_last_2days", "avg_sales_last_3days",
     "avg_sales_last_4days", "avg_sales_last_5days", "avg_sales_by_month"),
)
_KEY = ("store_id", "date")  # a store has one row per day


def cleaned(sales: DataFrame) -> DataFrame:
    """Rows with sales; missing numbers are 0, rows still incomplete are dropped."""
    sold = shape.greater_than(sales, "sale_amount", 0)
    return shape.complete_rows(impute.fill_numbers(sold, 0))


def fitted(
    table: DataFrame, categories: Sequence[str], numbers: Sequence[str], fraction: float = 0.7
) -> tuple[PipelineModel, DataFrame]:
    """The model of ``sale_amount`` and its predictions for the held-out rows."""
    learn, holdout = split.split(table, _KEY, [fraction, 1 - fraction])
    stages = encode.feature_stages(
        encode.usable_categories(learn, categories), numbers, keep_unseen=True, numbers_first=True
    )
    model = train.estimator("linear", labelCol="sale_amount", maxIter=500, regParam=0.0)
    pipeline = train.fit(learn, stages, model)
    return pipeline, train.score(pipeline, holdout, [*_KEY, "sale_amount"])


def run(spark: SparkSession, source: str, target: str) -> None:
    """Fit both models; write their measures, predictions and the models."""
    table = cleaned(readers.csv(spark, source, schemas.SALES, header=False))
    for name, (categories, numbers) in {"short": SHORT, "long": LONG}.items():
        pipeline, predicted = fitted(table, categories, numbers)
        sinks.save_model(pipeline, f"{target}/{name}/model")
        sinks.write_table(predicted, f"{target}/{name}/predicted")
        kept = spark.read.parquet(f"{target}/{name}/predicted")
        for measure in (evaluate.rmse, evaluate.r_squared):
            sinks.write_csv(
                measure(kept, "sale_amount", "prediction"), f"{target}/{name}/{measure.__name__}"
            )


if __name__ == "__main__":
    run(SparkSession.builder.appName("sales").getOrCreate(), *sys.argv[1:3])
