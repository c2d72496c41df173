"""Document fingerprints by winnowing.

A text is read as words, very long ones as characters; every run of K words is hashed, and of every WINDOW
neighbouring hashes the smallest is chosen, between equals the rightmost.  Two
texts that share K + WINDOW - 1 of these in a row share a chosen hash for certain.
Chosen hashes keep their place.  A hash (36 bits) and its place share one
number, hash first, so that the smallest number is the wanted one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm import common

K = 5
WINDOW = 12
_PLACE_BITS = 27
_LAST_PLACE = (1 << _PLACE_BITS) - 1
_LONG_WORD = 40


def with_tokens(df: DataFrame, text: str, name: str) -> DataFrame:
    """Words between white space; a very long word is cut into its characters.

    What a word becomes depends on that word alone, whatever surrounds it.
    """
    words = F.split(text, r"[\x20\x09-\x0D]+")
    long = lambda w: F.length(w) > _LONG_WORD
    cut = F.flatten(F.transform(name, lambda w: F.when(long(w), F.split(w, "")).otherwise(F.array(w))))
    return df.withColumn(name, words).withColumn(name, F.when(F.exists(name, long), cut).otherwise(F.col(name)))


def with_chosen(df: DataFrame, text: str, name: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """Add the chosen hashes of column ``text`` as an array of numbers in text order.

    Shorter texts have one run, and fewer hashes than a window are one window.
    """
    tokens, coded = f"{name}_tokens", f"{name}_coded"
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(tokens) - (k - 1), F.lit(1))),
        lambda i: F.shiftleft(
            F.shiftrightunsigned(F.xxhash64(F.slice(tokens, i, k)), 64 - 36), _PLACE_BITS
        ).bitwiseOR(F.greatest(F.lit(_LAST_PLACE) - (i - 1), F.lit(0)).cast("long")),
    )
    chosen = F.array_distinct(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(coded) - (window - 1), F.lit(1))),
            lambda j: F.array_min(F.slice(coded, j, window)),
        )
    )
    return (
        with_tokens(df, text, tokens)
        .withColumn(coded, runs)
        .withColumn(name, chosen)
        .drop(tokens, coded)
    )


def hashes(chosen: str | Column) -> Column:
    return F.transform(chosen, lambda x: F.shiftrightunsigned(x, _PLACE_BITS))


def places(chosen: str | Column) -> Column:
    return F.transform(chosen, lambda x: F.lit(_LAST_PLACE) - x.bitwiseAND(F.lit(_LAST_PLACE)))


def as_text(chosen: str) -> Column:
    """``hash@place`` for every chosen hash, hash in hexadecimal."""
    return F.array_join(
        F.transform(
            chosen,
            lambda x: F.concat(
                F.lower(F.hex(F.shiftrightunsigned(x, _PLACE_BITS))),
                F.lit("@"),
                (F.lit(_LAST_PLACE) - x.bitwiseAND(F.lit(_LAST_PLACE))).cast("string"),
            ),
        ),
        " ",
    )


def likeness(a: str, b: str) -> Column:
    """Hashes in both over hashes in either, 0 to 1; 1 for equal texts."""
    x, y = hashes(a), hashes(b)
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def _order() -> list[Column]:
    """Descending doc_id, NULL last; texts under one id by their hash."""
    return [
        F.col("doc_id").isNull().alias("unknown"),
        F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("descending"),
        F.col("text_key"),
    ]


def _with_buckets(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """``docs`` in buckets that are stretches of the order, a few per shuffle partition.

    The first document of every bucket is also added, as ``extra``, to the
    bucket before, and the first of all to the last bucket: so each document's
    successor is in its bucket.  Only the first keys of the buckets, whose number
    the settings bound, reach the driver.
    """
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    light = texts.select(*_order()).distinct()
    rows = common.laid_out(light, [F.col(c) for c in light.columns], buckets)
    key = F.struct(*light.columns)
    firsts = sorted(tuple(r.first) for r in rows.groupBy("range").agg(F.min(key).alias("first")).collect())
    if not firsts:
        return docs.withColumns({"bucket": F.lit(0), "extra": F.lit(False)})
    known = F.array(*[
        F.struct(F.lit(u).alias("unknown"), F.lit(d).cast("long").alias("descending"), F.lit(t).cast("long").alias("text_key"))
        for u, d, t in firsts
    ])
    own = F.struct(*_order())
    number = F.size(F.filter(known, lambda first: first <= own)) - 1
    placed = docs.withColumn("number", number).withColumn("is_first", F.array_contains(known, own))
    before = F.pmod(F.col("number") - 1, F.lit(len(firsts)))
    return placed.withColumn(
        "place",
        F.explode(F.array(
            F.struct(F.col("number").alias("bucket"), F.lit(False).alias("extra")),
            F.when(F.col("is_first"), F.struct(before.alias("bucket"), F.lit(True).alias("extra"))),
        )),
    ).where("place IS NOT NULL").select(*docs.columns, "place.bucket", "place.extra")


def edited_pairs(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Every text, its edited text and the next text, with their chosen hashes.

    In the edited text the last third (rounded down) gives way to as many
    characters, or all, of the next document's beginning.  The next document is
    that of the next smaller doc_id; texts under one id follow each other by
    their hash, NULL ids come last, and after the last comes the first.  A row
    that repeats id and text follows its like.  NULL texts are empty; an empty
    text's edited text is empty.  Columns: doc_id, text, edited, chosen,
    edited_chosen, next_chosen.  Every row of ``docs`` gives one row.
    """
    texts = common.keyed(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), "text"
    )
    full = _with_buckets(with_chosen(texts, "text", "chosen", k, window), texts)
    along = Window.partitionBy("bucket").orderBy("extra", *_order())
    third = (F.length("text") / 3).cast("int")
    paired = full.select(
        "doc_id",
        "text",
        "chosen",
        "extra",
        F.lead("text").over(along).alias("next"),
        F.lead("chosen").over(along).alias("next_chosen"),
    ).where(~F.col("extra"))
    joined = paired.select(
        "doc_id",
        "text",
        F.concat(
            F.substring("text", F.lit(1), F.length("text") - third), F.substring("next", F.lit(1), third)
        ).alias("edited"),
        "chosen",
        "next_chosen",
    )
    return with_chosen(joined, "edited", "edited_chosen", k, window)
