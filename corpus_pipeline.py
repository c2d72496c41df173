"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the docs of the next.  All but the last return the
columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import decontaminate, jaccard, line_dedup, packing, quality
from tallymark.llm.common import on_workers, read
from tallymark.session import use_checkpoint_folder


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    on_workers(spark)
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every longer line only where it is earliest; documents left without any word go."""
    on_workers(spark)
    lines = line_dedup.deduplicated(docs)
    changed = lines.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\s]")).withColumn(
        "n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    )
    return changed.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar word shingles the one with the smallest id."""
    on_workers(spark)
    return jaccard.one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words fewer than one in twenty lie in benchmark passages."""
    on_workers(spark)
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids."""
    on_workers(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmarks),
    ("packing", packed),
]

# Language-model scores, lines within one edit and packing are beyond SQL; the
# stages are tested against brute force instead.
ORACLE_SQL = None


def _place(spark: SparkSession, path: str):
    """The file system of a path and the path, whatever store it lies in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _finished(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def _remove(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``, each from the last one's files.

    With a ``folder``, which all executors must reach, the files of every stage
    stay there, and a run that is begun again goes on behind the last stage that
    was finished.  Without one they lie in the checkpoint folder: a stage's files
    go as soon as the next stage is written, those of the last one stay for the
    caller, and a run that fails leaves none.
    """
    use_checkpoint_folder(spark)
    base = folder or f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs, before = read(spark, sf_dir, "documents"), None
    try:
        for name, stage in STAGES:
            here = f"{base}/{name}"
            if not _finished(spark, here):
                stage(spark, docs, sf_dir).write.mode("overwrite").parquet(here)
            docs = spark.read.parquet(here)
            if before and not folder:
                _remove(spark, before)
            before = here
    except BaseException:
        if not folder:
            _remove(spark, base)
        raise
    return docs
