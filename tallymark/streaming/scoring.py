"""Score files with a fitted pipeline as they arrive in a folder.

Scoring looks at one row at a time, so the stream needs no state and no
watermark; the query's own checkpoint makes every file count once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallymark.operators.train import score


def score_stream(
    spark: SparkSession,
    model: PipelineModel,
    source: str,
    schema: StructType,
    keep: Sequence[str],
    target: str,
    progress: str,
    once: bool = True,
) -> StreamingQuery:
    """Read CSV files with a header, score them, append parquet files.

    ``progress`` is the query's checkpoint folder.  With ``once`` the query
    handles what is there and stops.
    """
    rows = spark.readStream.schema(schema).option("header", True).csv(source)
    writer = (
        score(model, rows, keep)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", progress)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
