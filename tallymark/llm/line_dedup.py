"""Line deduplication within one edit, by a deletion neighbourhood.

Lines are compared as words.  Two lines are within one edit (a word replaced,
added or left out) exactly when deleting at most one word from each gives the
same words: at the same place for a replaced word, from the longer line alone
otherwise.  Every variant is a hashed key; equal keys meet in a grouped minimum,
so no group of similar lines is ever gathered or paired up.

Variants are made only for lines that can have a partner: two lines within one
edit share their first or their last half, so lines whose halves are unique are
left out beforehand.  Equal lines are one line from the start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm import common
from tallymark.session import reliable_copy

MIN_WORDS = 5
# Lines with fewer words take part, in the exact comparison only, from so many characters on.
MIN_CHARS = 40

# Line numbers that may be broadcast: 4 bytes each, and a key for every document.
BROADCAST_LINES = 4_000_000

_HASH_BITS = 40  # sums of up to 2**23 such hashes fit a long
_PLACE = ("doc_id", "text_key", "no")


def normal_form(line: Column) -> Column:
    """Lower case, words separated by single blanks."""
    odd = line.contains("  ") | line.contains("\t") | line.contains("\r") | line.contains("\f")
    return F.trim(F.lower(F.when(odd, F.regexp_replace(line, r"[ \t\r\f]+", " ")).otherwise(line)))


def word_count(normal: Column) -> Column:
    return F.when(normal == "", 0).otherwise(
        F.octet_length(normal) - F.octet_length(F.replace(normal, F.lit(" "), F.lit(""))) + 1
    )


def _takes_part(normal: Column, n: Column, min_words: int) -> Column:
    return (F.length(normal) >= MIN_CHARS) | (n >= min_words)


def _long_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, text_key, no, normal, n) of every line with enough words or characters."""
    return (
        common.keyed(docs, F.posexplode_outer(F.split("text", "\n")).alias("no", "line"))
        .select(*_PLACE, normal_form(F.col("line")).alias("normal"))
        .withColumn("n", word_count(F.col("normal")))
        .where(_takes_part(F.col("normal"), F.col("n"), min_words))
    )


def _halves(normal: Column, n: Column) -> Column:
    """(half, last, h): keys of the first and last ``h`` words of a line.

    A partner may have as many words, one fewer or one more, so ``h`` follows
    from the length of the shorter of the two: at most half of it.
    """
    def keys(m: Column) -> list[Column]:
        h = F.call_function("shiftleft", F.lit(1), (F.floor(F.log2(m)) - 1).cast("int"))
        return [_half(normal, last, h) for last in (False, True)]

    # Lines of n and n - 1 words have the same h, unless n is a power of two.
    power = n.bitwiseAND(n - 1) == 0
    return F.when(power, F.array(*keys(n), *keys(n - 1))).otherwise(F.array(*keys(n)))


def _half(normal: Column, last: bool, h: Column) -> Column:
    part = F.call_function("substring_index", normal, F.lit(" "), -h if last else h)
    return F.struct(F.xxhash64(F.lit(last), h, part).alias("half"), F.lit(last).alias("last"), h.alias("h"))


def first_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(line, doc_id, text_key, no, halves): the earliest place of every distinct line.

    Earlier is the smaller doc_id (NULL last), then the text's hash, then the
    line number.  Distinct lines are told apart by 128 bits of hash; ``line`` is
    half of them.  Lines with fewer than ``min_words`` words have no halves.
    """
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), *_PLACE)
    normal = F.col("normal")
    halves = F.when(F.col("n") >= min_words, _halves(normal, F.col("n")))
    return (
        _long_lines(docs, min_words)
        .select(
            F.xxhash64(normal).alias("line"),
            F.xxhash64(F.lit(1), normal).alias("line2"),
            place.alias("place"),
            halves.alias("halves"),
        )
        .groupBy("line", "line2")
        .agg(F.min(F.struct("place", "halves")).alias("first"))
        .select("line", "first.place.doc_id", "first.place.text_key", "first.place.no", "first.halves")
    )


def _with_partner(firsts: DataFrame) -> DataFrame:
    """(doc_id, text_key, no, first_h, last_h): lines that share a half with another line.

    ``first_h`` and ``last_h`` are the shortest first and last parts shared, NULL
    where none is: an edit lies behind the one or before the other.
    """
    halves = firsts.select("line", F.explode("halves").alias("x")).select("line", "x.half", "x.last", "x.h")
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    lines = halves.join(shared, "half", "left_semi").groupBy("line").agg(
        F.min(F.when(~F.col("last"), F.col("h"))).alias("first_h"),
        F.min(F.when(F.col("last"), F.col("h"))).alias("last_h"),
    )
    return firsts.drop("halves").join(lines, "line").drop("line")


def _broadcast_if_few(lists: DataFrame, name: str) -> DataFrame:
    """One list a document, with a broadcast hint where all lists together are short enough."""
    numbers = lists.agg(F.sum(F.size(name))).first()[0] or 0
    return F.broadcast(lists) if numbers <= BROADCAST_LINES else lists


def _their_words(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(id, doc_id, text_key, no, words, first_h, last_h), ids in order of place."""
    line = F.struct("no", "first_h", "last_h")
    lists = reliable_copy(places.groupBy(*common.KEY).agg(F.collect_list(line).alias("wanted")))
    wanted = _broadcast_if_few(lists, "wanted")
    texts = common.keyed(docs, "text")
    lines = (
        texts.join(wanted, common.same_document(texts, wanted))
        .select(texts["doc_id"], texts["text_key"], F.split("text", "\n").alias("lines"), "wanted")
        .select(*common.KEY, "lines", F.explode("wanted").alias("x"))
        .select(
            *common.KEY,
            "x.no",
            F.split(normal_form(F.get("lines", F.col("x.no"))), " ").alias("words"),
            "x.first_h",
            "x.last_h",
        )
        .dropDuplicates(list(_PLACE))
    )
    order = [F.col("doc_id").isNull(), *map(F.col, _PLACE)]
    number = F.row_number().over(common.within_range(order))
    return reliable_copy(
        common.laid_out(lines, order).select(
            (F.call_function("shiftleft", F.col("range").cast("long"), F.lit(40)) + number).alias("id"),
            *_PLACE,
            "words",
            "first_h",
            "last_h",
        )
    )


def variants(lines: DataFrame) -> DataFrame:
    """(key, cut, id): each line whole (cut 0) and without its word ``cut``.

    The hash of a word sequence is made from the sums of the hashes of (word,
    place), two of them; leaving a word out moves the later places by one.  Cuts
    inside a part that the line shares with its only possible partners are left out.
    """
    modulus = F.lit(1 << _HASH_BITS)
    words = lines.select("id", "first_h", "last_h", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))
    spread = words.select("id", "n", "at", "first_h", "last_h", F.xxhash64("word").alias("w")).repartition("id")
    hashed = spread.select(
        "*",
        *[F.pmod(F.xxhash64(F.lit(x), "w", "at"), modulus).alias(f"stay{x}") for x in (1, 2)],
        *[F.pmod(F.xxhash64(F.lit(x), "w", F.col("at") - 1), modulus).alias(f"move{x}") for x in (1, 2)],
    )
    line = Window.partitionBy("id")
    along = line.orderBy("at")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    none = F.lit(0).cast("long")
    sums = hashed.select(
        "id",
        "n",
        (F.col("at") + 1).alias("cut"),
        "first_h",
        "last_h",
        *[
            (F.coalesce(F.sum(f"stay{x}").over(before), none)
             + F.sum(f"move{x}").over(line) - F.sum(f"move{x}").over(upto)).alias(f"without{x}")
            for x in (1, 2)
        ],
        *[F.sum(f"stay{x}").over(line).alias(f"whole{x}") for x in (1, 2)],
    )
    wanted = (F.col("cut") > F.col("first_h")) | (F.col("cut") <= F.col("n") - F.col("last_h"))
    shortened = F.struct(F.xxhash64(F.col("n") - 1, "without1", "without2").alias("key"), "cut")
    whole = F.struct(F.xxhash64("n", "whole1", "whole2").alias("key"), F.lit(0).alias("cut"))
    rows = F.array(
        F.when(F.coalesce(wanted, F.lit(False)), shortened), F.when(F.col("cut") == 1, whole)
    )
    return sums.select("id", F.explode(rows).alias("x")).where("x IS NOT NULL").select("x.key", "x.cut", "id")


def _earlier_partner(keys: DataFrame) -> DataFrame:
    """(id, partner): the earliest line with an equal variant, where it comes before."""
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    met = reliable_copy(keys.join(shared, "key", "left_semi"))
    cuts = met.groupBy("key", "cut").agg(F.min("id").alias("low"))
    lengths = cuts.groupBy("key").agg(
        F.min(F.when(F.col("cut") == 0, F.col("low"))).alias("whole"),
        F.min(F.when(F.col("cut") > 0, F.col("low"))).alias("shortened"),
    )
    best = cuts.join(lengths, "key").select(
        "key",
        "cut",
        F.when(F.col("cut") == 0, F.col("shortened")).otherwise(F.least("low", "whole")).alias("partner"),
    )
    return (
        met.join(best, ["key", "cut"])
        .where(F.col("partner") < F.col("id"))
        .groupBy("id")
        .agg(F.min("partner").alias("partner"))
    )


def within_one_edit(x: str, y: str) -> Column:
    """Whether two word arrays differ by at most one word replaced, added or left out."""
    differ = F.transform(F.arrays_zip(F.col(x).alias("x"), F.col(y).alias("y")), lambda p: p["x"].eqNullSafe(p["y"]))
    at = F.array_position(differ, F.lit(False)).cast("int")
    rest = lambda c, start: F.slice(c, start, F.greatest(F.size(c), F.lit(1)))
    return (at == 0) | (
        (rest(x, at + 1) == rest(y, at + 1))
        | (rest(x, at + 1) == rest(y, at))
        | (rest(x, at) == rest(y, at + 1))
    )


def near_copies(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Places of distinct lines that are one edit away from an earlier distinct line."""
    lines = _their_words(docs, _with_partner(firsts))
    met = _earlier_partner(reliable_copy(variants(lines)))
    x = lines.select("id", *_PLACE, F.col("words").alias("x"))
    y = lines.select(F.col("id").alias("partner"), F.col("words").alias("y"))
    return met.join(x, "id").join(y, "partner").where(within_one_edit("x", "y")).select(*_PLACE)


def kept_lines(docs: DataFrame, min_words: int = MIN_WORDS, near: bool = True) -> DataFrame:
    """(doc_id, text_key, nos): the long lines of each document that stay."""
    firsts = reliable_copy(first_lines(docs, min_words))
    stay = firsts.select(*_PLACE)
    if near:
        gone = near_copies(docs, firsts)
        same = common.same_document(stay, gone) & (stay["no"] == gone["no"])
        stay = stay.join(gone, same, "left_anti")
    lists = reliable_copy(stay.groupBy(*common.KEY).agg(F.collect_list("no").alias("nos")))
    return _broadcast_if_few(lists, "nos")


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS, near: bool = True) -> DataFrame:
    """``docs`` with every line of ``min_words`` words or more kept only where it is earliest.

    So is a line of fewer words with MIN_CHARS characters or more, but it goes
    for an equal line alone: one word of few is too much for an edit.
    A line goes when an equal line, or one within one edit of a word, stands
    earlier anywhere in the table: in a document with a smaller doc_id (NULL is
    last), or further up in the same document.  Whether that earlier line goes
    itself does not matter.  Case and the amount of white space do not count.
    Shorter and blank lines stay.  NULL text stays NULL.  Rows that repeat id
    and text are one document and are treated alike.  All columns stay; three
    are added: ``n_lines``, ``n_dropped`` and ``old_text``; own columns of those
    names are replaced.
    """
    added = ("n_lines", "n_dropped", "old_text")
    own = [c for c in docs.columns if c not in added]
    rows = common.beside(docs.select(*own), "doc_id", "text", text_key=F.xxhash64("text"))
    kept = kept_lines(docs, min_words, near)
    joined = rows.join(kept, common.same_document(rows, kept), "left").select("row", "text", "nos")
    # One-element lists, exploded: what is made before them is not made again by later expressions.
    split_up = joined.select("*", F.explode_outer(F.array(F.split("text", "\n"))).alias("lines"))
    short = F.transform(
        F.transform("lines", normal_form),
        lambda normal, i: F.when(~_takes_part(normal, word_count(normal), min_words), i),
    )
    stay = F.array_sort(
        F.array_union(F.filter(short, lambda i: i.isNotNull()), F.coalesce("nos", F.array().cast("array<int>")))
    )
    placed = split_up.select("*", F.explode_outer(F.array(stay)).alias("stay"))
    rebuilt = F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n")
    known = F.col("text").isNotNull()
    result = F.struct(
        F.when(known, rebuilt).alias("text"),
        F.when(known, F.size("lines")).otherwise(0).cast("long").alias("n_lines"),
        F.when(known, F.size("lines") - F.size("stay")).otherwise(0).cast("long").alias("n_dropped"),
    )
    done = placed.select("row", "text", F.explode_outer(F.array(result)).alias("done"))
    return done.select(
        *[F.col("row")[c].alias(c) for c in own if c != "text"],
        "done.text",
        "done.n_lines",
        "done.n_dropped",
        F.col("text").alias("old_text"),
    )
