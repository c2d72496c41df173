"""Licence scan by a positional index of rare licence words.

Each document keeps its own postings of the licence words that are rarest in
the corpus.  Such a posting fixes where a template would begin; the template's
other words are then compared at their relative positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import common
from tallymark.session import reliable_copy

# Phrases that must stand word for word, and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Fixed values: (label, template, key phrase).  A template counts when its key
# phrase stands at its place and at least MIN_SHARE of its words match.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("apache-2.0", "apache license version 2 0 january 2004", "apache license version 2"),
    ("gpl-2.0", "gnu general public license as published by the free software foundation either version 2", "general public license"),
    ("gpl-3.0", "gnu general public license version 3", "general public license version 3"),
    ("gpl-3.0", "gnu general public license as published by the free software foundation either version 3", "either version 3"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("cc-by-4.0", "creative commons attribution 4 0 international license", "creative commons attribution 4"),
    ("cc-by-4.0", "cc by 4 0", "cc by 4"),
    ("cc-by-sa", "cc by sa", "cc by sa"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source"),
    ("mpl-2.0", "mozilla public license version 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "this permission notice shall be included"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer", "redistributions in binary form must reproduce"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", "nor the names of its contributors"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "will the authors be held liable"),
    ("bsl-1.0", "boost software license version 1 0", "boost software license"),
    ("epl-1.0", "eclipse public license v 1 0", "eclipse public license v 1"),
    ("epl-2.0", "eclipse public license v 2 0", "eclipse public license v 2"),
    ("gfdl", "gnu free documentation license", "gnu free documentation license"),
    ("gpl-exception", "as a special exception the copyright holders of this library give you permission to link this library", "as a special exception"),
    ("cc-by-nc", "cc by nc", "cc by nc"),
    ("cc-by-nd", "cc by nd", "cc by nd"),
    ("cc0-1.0", "cc0 1 0 universal", "cc0 1 0"),
    ("artistic-2.0", "artistic license 2 0", "artistic license 2 0"),
)
MIN_SHARE = 0.75


def templates(spark: SparkSession) -> DataFrame:
    """(template, label, base, words, key_at, key_length)."""
    rows = [(p, label, True, p, p) for p, label in BASE]
    rows += [(t, label, False, t, key) for label, t, key in TEMPLATES]
    made = []
    for number, (_, label, base, text, key) in enumerate(rows):
        words, wanted = text.split(), key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(wanted)] == wanted)
        cells = {"template": F.lit(number), "label": F.lit(label), "base": F.lit(base),
                 "words": F.array(*map(F.lit, words)), "key_at": F.lit(at), "key_length": F.lit(len(wanted))}
        made.append(F.struct(*[c.alias(name) for name, c in cells.items()]))
    # Literals: nothing is sent to Python workers.
    return spark.range(1).select(F.inline(F.array(*made)))


def _postings(docs: DataFrame) -> DataFrame:
    return (
        common.keyed(docs, "text")
        .select(*common.KEY, common.pieces(F.col("text")).alias("own"))
        .select(*common.KEY, "own", F.posexplode_outer("own").alias("at", "raw"))
        .select(*common.KEY, "own", "at", F.lower("raw").alias("term"))
    )


def anchors(docs: DataFrame, known: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """(template, size, off, term): the rarest words of every template and their offsets.

    Rarity is counted over all documents.  One word more is taken than may be
    missing, so a place that matches has at least one of them.
    """
    vocabulary = known.select(F.explode("words").alias("term")).distinct()
    terms = common.keyed(docs, "text").select(
        F.explode_outer(common.pieces(F.col("text"))).alias("raw")
    ).select(F.lower("raw").alias("term"))
    counts = terms.join(common.broadcast_if_small(vocabulary), "term").groupBy("term").agg(F.count("*").alias("df"))
    places = known.select("*", F.posexplode("words").alias("off", "term"))
    ranked = places.join(counts, "term", "left").select(
        "*", F.struct(F.coalesce("df", F.lit(0)), "off", "term").alias("rarity")
    )
    missing = F.size("words") - F.ceil(F.size("words") * min_share).cast("int")
    wanted = F.when(F.col("base"), 1).otherwise(missing + 1)
    chosen = ranked.groupBy("template").agg(F.sort_array(F.collect_list("rarity")).alias("all"))
    return known.join(chosen, "template").select(
        "template", F.size("words").alias("size"), F.explode(F.slice("all", F.lit(1), wanted)).alias("anchor")
    ).select("template", "size", "anchor.off", "anchor.term")


def matches(docs: DataFrame, known: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """Places where a template stands: key, template, label, base, start, share.

    ``share`` is the part of the template's words found at their places; base
    phrases need all of them, the others their key phrase and ``min_share``.
    A-Z count as a-z.  Templates may overlap each other and repeat.
    """
    lifted = reliable_copy(anchors(docs, known, min_share))
    first = F.col("at") - F.col("off")  # place of the template's first word among the pieces
    placed = (
        _postings(docs)
        .join(common.broadcast_if_small(lifted), "term")
        .where(first >= 0)
        .select(
            *common.KEY,
            "template",
            (first - common.empty_first(F.col("own"))).cast("long").alias("start"),
            F.array_join(F.slice("own", first + 1, F.col("size")), " ").alias("there"),
        )
        .distinct()
    )
    own = F.split(common.ascii_lower(F.col("there")), " ")
    compared = placed.join(common.broadcast_if_small(known), "template").withColumn(
        "same", F.zip_with(own, "words", lambda a, b: F.coalesce(a == b, F.lit(False)))
    )
    return (
        compared.withColumn("share", F.size(F.filter("same", lambda x: x)) / F.size("words"))
        .where(F.when(F.col("base"), F.col("share") == 1).otherwise(F.col("share") >= min_share))
        .where(F.forall(F.slice("same", F.col("key_at") + 1, F.col("key_length")), lambda x: x))
        .select(*common.KEY, "template", "label", "base", "start", "share")
    )


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per document row: key, n_words, places of base phrases and labels.

    n_base counts all places of base phrases, first_word and last_word are the
    smallest and largest start (NULL without any); base_labels and labels are
    sorted lists; score is the largest share of a template found, else 0.
    NULL and empty texts have no words and no labels.
    """
    known = reliable_copy(templates(docs.sparkSession) if known is None else known)
    per_doc = matches(docs, known).groupBy(*common.KEY).agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        F.collect_set(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        F.collect_set("label").alias("labels"),
        F.max("share").alias("score"),
    )
    counted = common.keyed(docs, "text").select(
        *common.KEY, common.n_words(common.pieces(F.col("text"))).alias("n_words")
    )
    none = F.array().cast("array<string>")
    return common.with_found(counted, per_doc).select(
        *common.KEY,
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.sort_array(F.coalesce("base_labels", none)).alias("base_labels"),
        F.sort_array(F.coalesce("labels", none)).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
