"""Benchmark decontamination by a positional inverted index.

A benchmark window is looked up by its two terms that are rarest in the training
text.  The postings (term, document, place) of such terms are stored, those of
rarest terms with the words around them; texts and postings of other words are
never moved.  A window's two lists, moved back by the offsets of their terms, are
intersected; where they meet (or nearly meet) the whole phrase is compared with
the words around.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm import common
from tallymark.session import reliable_copy

WINDOW = 13
SLOP = 3


def item_words(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_key, n_words, pos, word, term); items without words have no rows."""
    words = common.pieces(F.col("text"))
    return (
        benchmark.where(F.col("text").isNotNull())
        .select("item_id", F.xxhash64("text").alias("item_key"), words.alias("words"))
        .select(
            "item_id",
            "item_key",
            common.n_words(F.col("words")).alias("n_words"),
            common.empty_first(F.col("words")).alias("skip"),
            F.posexplode_outer("words").alias("at", "raw"),
        )
        .where(F.col("raw") != "")
        .select(
            "item_id",
            "item_key",
            "n_words",
            (F.col("at") - F.col("skip")).alias("pos"),
            common.ascii_lower(F.col("raw")).alias("word"),
            F.lower("raw").alias("term"),
        )
        .distinct()
    )


def stored_postings(docs: DataFrame, looked_up: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, at, term, first, around): where the windows' terms stand, written once.

    Places are words from 0.  A term that is the rarest of some window has the
    words of its surroundings with it, as many as any window may need, the first of
    them at place ``first``; other terms have none.
    """
    both = F.explode(F.array(F.struct("term", F.lit(True).alias("leads")), F.struct(F.col("term2").alias("term"), F.lit(False).alias("leads"))))
    terms = looked_up.select(both.alias("x")).where("x.term IS NOT NULL").groupBy("x.term").agg(F.max("x.leads").alias("leads"))
    words = (
        common.keyed(docs, "text")
        .select(*common.KEY, common.pieces(F.col("text")).alias("words"))
        .select(*common.KEY, "words", F.posexplode_outer("words").alias("at", "raw"))
        .select(*common.KEY, "words", common.empty_first(F.col("words")).alias("skip"), "at", F.lower("raw").alias("term"))
    )
    first = F.greatest(F.col("at") - (size - 1), F.col("skip"))
    around = F.slice("words", first + 1, F.col("at") - first + size)
    # Every term is one row here, so every block is small and the texts are not moved.
    parts = [
        words.join(part, "term").select(
            *common.KEY,
            (F.col("at") - F.col("skip")).alias("at"),
            "term",
            (first - F.col("skip")).alias("first"),
            F.when(F.col("leads"), around).alias("around"),
        )
        for part in common.blocks(reliable_copy(terms), "term")
    ]
    return reliable_copy(reduce(DataFrame.unionByName, parts))


def term_frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, df): how often each of ``terms`` occurs in all documents."""
    words = common.keyed(docs, "text").select(
        F.explode_outer(common.pieces(F.col("text"))).alias("raw")
    ).select(F.lower("raw").alias("term"))
    counted = [
        words.join(part, "term").groupBy("term").agg(F.count("*").alias("df"))
        for part in common.blocks(terms.select("term").distinct(), "term")
    ]
    counts = reduce(DataFrame.unionByName, counted)
    return terms.select("term").distinct().join(counts, "term", "left").select(
        "term", F.coalesce("df", F.lit(0)).alias("df")
    )


def windows(words: DataFrame, frequencies: DataFrame, size: int = WINDOW) -> DataFrame:
    """Windows with their phrase, and the offsets of their two rarest terms.

    A window that occurs in several items or places is one row per item.
    """
    spread = words.join(frequencies, "term").withColumn(
        "start",
        F.explode(
            F.sequence(
                F.greatest(F.col("pos") - size + 1, F.lit(0)),
                F.least(F.col("pos").cast("long"), F.greatest(F.col("n_words") - size, F.lit(0))).cast("int"),
            )
        ),
    )
    inside = F.struct("df", (F.col("pos") - F.col("start")).alias("off"), "term", "word")
    whole = spread.groupBy("item_id", "item_key", "start").agg(F.sort_array(F.collect_set(inside)).alias("rare"))
    by_place = F.sort_array(F.transform("rare", lambda x: F.struct(x["off"], x["word"].alias("word"))))
    return whole.select(
        "item_id",
        F.array_join(F.transform(by_place, lambda x: x["word"]), " ").alias("phrase"),
        F.size("rare").alias("length"),
        F.col("rare")[0]["term"].alias("term"),
        F.col("rare")[0]["off"].alias("off"),
        F.get("rare", F.lit(1))["term"].alias("term2"),
        (F.get("rare", F.lit(1))["off"] - F.col("rare")[0]["off"]).alias("step"),
    ).distinct()


def meetings(looked_up: DataFrame, postings: DataFrame, slop: int = 0) -> DataFrame:
    """(key, item_id, start, length, there, phrase): where two lists of a window meet.

    The list of its rarest term and that of its second rarest, both moved back by
    their offsets, are intersected.  With ``slop`` their places differ by 1 to
    ``slop`` words instead.  A window of one term has one list.  ``there`` has the
    document's words at the places of the window.
    """
    start = F.col("at") - F.col("off")
    there = F.slice("around", F.greatest(start - F.col("first"), F.lit(0)) + 1, F.col("length"))
    first = postings.where("around IS NOT NULL").join(looked_up, "term").select(
        *common.KEY, "item_id", start.alias("start"), "length", "at", "step", "term2", "phrase",
        common.ascii_lower(F.array_join(there, " ")).alias("there"),
    )
    second = postings.select(
        F.col("doc_id").alias("doc_id_2"), F.col("text_key").alias("text_key_2"), F.col("at").alias("at_2"), F.col("term").alias("other")
    )
    found = [*common.KEY, "item_id", "start", "length", "there", "phrase"]
    beside = (
        F.col("doc_id").eqNullSafe(F.col("doc_id_2")) & (F.col("text_key") == F.col("text_key_2")) & (F.col("term2") == F.col("other"))
    )
    if slop:
        apart = F.abs(F.col("at_2") - F.col("at") - F.col("step"))
        near = beside & apart.between(1, slop) & (F.col("at_2") != F.col("at"))
        return first.join(second, near, "left_semi").select(*found)
    met = beside & (F.col("at_2") == F.col("at") + F.col("step"))
    both = first.where("term2 IS NOT NULL").join(second, met, "left_semi").select(*found)
    return both.unionByName(first.where("term2 IS NULL").select(*found)).where("start >= 0")


def matches(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, slop: int = SLOP, proximity: bool = True
) -> DataFrame:
    """Exact phrase and proximity matches of every benchmark window.

    Columns: doc_id, text_key, item_id, start (words from 0), length, kind.
    ``exact``: the window's words stand there one after the other.  ``near``:
    its two rarest terms stand in the document in a distance that differs by 1
    to ``slop`` words from that in the window (start follows from the rarest).
    Words are compared with A-Z lowered.  NULL and empty texts match nothing.
    ``proximity=False`` leaves the near ones out.
    """
    words = item_words(benchmark)
    looked_up = reliable_copy(windows(words, term_frequencies(docs, words), size))
    postings = stored_postings(docs, looked_up, size)
    columns = [*common.KEY, "item_id", "start", "length"]
    met = meetings(looked_up, postings)
    exact = met.where("there = phrase").select(*columns, F.lit("exact").alias("kind")).distinct()
    if not proximity:
        return exact
    near = meetings(looked_up, postings, slop)
    return exact.unionByName(near.select(*columns, F.lit("near").alias("kind")))


def report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document row: its words, words hit, and the items found in it.

    A word is hit when it lies in any exact occurrence of a window.  Without
    words everything is 0 and the list of items empty.  Columns: the key,
    n_words, n_hit, n_items, items (sorted as text), contaminated (at least one
    word in twenty is hit).
    """
    exact = matches(docs, benchmark, size, proximity=False)
    per_doc = exact.groupBy(*common.KEY).agg(
        F.collect_set(F.struct("start", "length")).alias("spans"),
        F.collect_set(F.col("item_id").cast("string")).alias("items"),
    )
    covered = F.array_distinct(
        F.flatten(
            F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))
        )
    )
    hits = per_doc.select(*common.KEY, F.size(covered).cast("long").alias("n_hit"), "items")
    counted = common.keyed(docs, "text").select(
        *common.KEY, common.n_words(common.pieces(F.col("text"))).alias("n_words")
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    # Names of their own: copies in between have the documents' columns, too.
    lists = hits.withColumnsRenamed({"doc_id": "found_id", "text_key": "found_key"})
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key"))
    return counted.join(lists, same, "left").select(
        *common.KEY,
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sort_array(items).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    dirty = report(docs, benchmark, size).where("contaminated").select(
        F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key")).distinct()
    plain = common.beside(docs, "doc_id", text_key=F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key"))
    return plain.join(dirty, same, "left_anti").select("row.*")
