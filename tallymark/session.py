"""Session set-up and the reliable-copy helper shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cpus: str | int = "*", memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and timing runs.

    On a cluster, build the session with ``spark-submit`` settings instead;
    nothing in this package depends on the values chosen here.
    """
    partitions = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_checkpoint_folder(spark: SparkSession) -> None:
    """Make sure checkpoints have a folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    fall back to a folder of this machine, which goes when Python ends.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="tallymark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)


def reliable_copy(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder once and continue from there.

    The copy keeps its partitions, survives the loss of executors, and is not
    recomputed when a plan reads it more than once.
    """
    use_checkpoint_folder(df.sparkSession)
    return df.checkpoint()
