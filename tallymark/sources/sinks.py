"""Writing results and fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Write CSV with a header, replacing what is there.

    ``one_file`` is for small reports only: a single task then writes all rows.
    """
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str) -> None:
    """Write parquet, replacing what is there."""
    df.write.mode("overwrite").parquet(path)


def submission(scored: DataFrame, key: str, positive: str = "pass", negative: str = "fail") -> DataFrame:
    """(ID, y): the predicted class of every key as text; NULL without a prediction."""
    word = F.when(F.col("prediction") == 1, positive).when(F.col("prediction").isNotNull(), negative)
    return scored.select(F.col(key).alias("ID"), word.alias("y"))


def probability_columns(scored: DataFrame, classes: int, column: str = "probability") -> DataFrame:
    """Replace the probabilities by plain columns, which a CSV file can hold.

    They may be a vector, as models give it, or an array, as ``score`` does.
    """
    is_array = isinstance(scored.schema[column].dataType, ArrayType)
    values = F.col(column) if is_array else vector_to_array(column)
    return scored.withColumns(
        {f"probability_{i}": values[i] for i in range(classes)}
    ).drop(column)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
