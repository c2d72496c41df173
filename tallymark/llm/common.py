"""Words, document keys and range sweeps shared by the text operators.

A document row is known by ``(doc_id, text_key)``: its id and a hash of its
text.  Rows that repeat both are one document written several times; they get
the same results.  ``doc_id`` may be NULL, and different texts under one id are
different documents.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.session import reliable_copy

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEY = ("doc_id", "text_key")

# Rows that may be broadcast at once; larger tables go in blocks of this size.
BROADCAST_ROWS = 100_000


def on_workers(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies on the driver's machine.

    That is enough for local sessions and shared folders; elsewhere submit the
    package with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    root = str(Path(__file__).resolve().parents[2])
    environment["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([root, *filter(None, known)]))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_kept: dict[str, Any] = {}


def kept(key: str, make: Callable[[], Any]) -> Any:
    """One thing per Python worker that tasks of one operator share, made when first wanted."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def let_go() -> None:
    """Drop what earlier tasks left in this Python worker, and give its free memory back."""
    _kept.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
    if trim:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInArrow, in a worker that holds no more than it needs before and after it."""

    def task(batches: Iterator) -> Iterator:
        let_go()
        yield from run(batches)
        let_go()

    return task


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id``, ``text_key`` and the named columns."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), *columns)


def beside(docs: DataFrame, *own: str, **added: Column) -> DataFrame:
    """The caller's whole row as ``row``, with some of its columns and added ones beside it.

    Whatever columns the caller has, they cannot clash with those: ``row.*`` gives
    them back.
    """
    return docs.select(F.struct("*").alias("row"), *own, *[c.alias(name) for name, c in added.items()])


def same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])


def with_found(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Left join of keyed documents with one row per document that has findings."""
    wanted = [found[c] for c in found.columns if c not in KEY]
    return docs.join(found, same_document(docs, found), "left").select(
        *[docs[c] for c in docs.columns], *wanted
    )


# Letters, digits and everything beyond ASCII make words; the rest separates them.
_NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def pieces(text: Column) -> Column:
    """The words in their own case, perhaps with an empty first and last piece."""
    return F.split(text, _NOT_WORD)


def empty_first(words: Column) -> Column:
    return F.when(F.get(words, F.lit(0)) == "", 1).otherwise(0)


def n_words(words: Column) -> Column:
    """How many words ``pieces`` holds; NULL text has none."""
    last = F.when((F.size(words) > 1) & (F.get(words, F.size(words) - 1) == ""), 1).otherwise(0)
    return F.coalesce(F.size(words) - empty_first(words) - last, F.lit(0)).cast("long")


def broadcast_if_small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` with a broadcast hint when a count shows that it is small enough.

    Larger tables are left as they are: the join then shuffles both sides.
    """
    return F.broadcast(table) if table.count() <= rows else table


def blocks(table: DataFrame, key: str, size: int = BROADCAST_ROWS) -> list[DataFrame]:
    """``table`` in parts that are small enough to be broadcast, split by ``key``."""
    n = table.count()
    if n <= size:
        return [F.broadcast(table)]
    parts = -(-2 * n // size)  # half full on average
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    return [b for i in range(parts) for b in _fitting(table.where(part == i), size)]


def _fitting(table: DataFrame, size: int) -> list[DataFrame]:
    """A part that many rows of one key have made too large stays a shuffled join."""
    return [F.broadcast(table) if table.count() <= size else table]


def laid_out(rows: DataFrame, order: Sequence[Column], ranges: int | None = None) -> DataFrame:
    """Rows in ranges along ``order``; ``range`` numbers them and does not change."""
    spread = rows.repartitionByRange(ranges, *order) if ranges else rows.repartitionByRange(*order)
    return reliable_copy(spread).withColumn("range", F.spark_partition_id())


def within_range(order: Sequence[Column]):
    return Window.partitionBy("range").orderBy(*order)
