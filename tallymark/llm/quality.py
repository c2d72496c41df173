"""Quality classifier: an interpolated modified Kneser-Ney model over bytes.

The model is trained on documents that labels call good.  An n-gram of up to
five bytes is one number (the bytes behind each other), so counts are exact and
hold no text.  Tasks count the n-grams of their documents block by block;
grouped sums make the counts, joins by n-gram and by context make one log
probability for every n-gram of the corpus, and these go back to the documents
in shards of bounded size.  A document's score is its mean negative log
probability per byte, drawn towards the usual one of its language when the text
is short.  It is rejected above a quantile of the scores of good documents of
its language that the model was not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm import common
from tallymark.session import reliable_copy

ORDER = 5
QUANTILE = 0.985
# Good documents whose id falls into one of FOLDS parts set the thresholds.
FOLDS = 5
# So many bytes at the language's median count towards every score.
PRIOR_BYTES = 100
# n-grams in one shard: 12 bytes each in every worker.
SHARD_ROWS = 4_000_000
# Scores are counted in steps of 1 / STEPS for the quantiles.
STEPS = 2000

_BLOCK = 4_000_000
_SLICE = 1_000_000
_START = 1  # byte before a text; control characters do not occur in prose


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Every n-gram of full order of the texts, and how many each text has."""
    start, stop = bytes([_START]) * (ORDER - 1), b"\x02"
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"".join(start + e + stop for e in encoded), np.uint8).astype(np.int64)
    sizes = np.array([len(e) + 1 if e else 0 for e in encoded], np.int64)
    if len(raw) < ORDER:
        return np.zeros(0, np.int64), sizes
    grams = raw[: len(raw) - ORDER + 1].copy()
    for i in range(1, ORDER):
        grams = (grams << 8) | raw[i : len(raw) - ORDER + 1 + i]
    lengths = np.array([len(e) + ORDER for e in encoded], np.int64)
    first = np.cumsum(lengths) - lengths
    keep = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return grams[keep], sizes


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[str]]]:
    """Rows of a batch in parts of bounded size: (from, to, texts)."""
    texts = batch.column("text")
    at, held, size = 0, [], 0
    for i, value in enumerate(texts):
        held.append(value.as_py())
        size += len(held[-1] or "") + ORDER
        if size >= _SLICE:
            yield at, i + 1, held
            at, held, size = i + 1, [], 0
    if held:
        yield at, len(texts), held


def _counted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of all parts, ascending, and how often each occurs; the parts are emptied."""
    grams = np.concatenate(parts)
    parts.clear()
    grams.sort()
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])[: len(grams)])
    return grams[first], np.diff(first, append=len(grams))


def _counter():
    schema = pa.schema([("gram", pa.int64()), ("times", pa.int64())])

    def summed(trained: list[np.ndarray], others: list[np.ndarray]) -> pa.RecordBatch:
        keys, times = _counted(trained)
        rest = _counted(others)[0]
        rest = rest[~np.isin(rest, keys, assume_unique=True)]
        both = np.concatenate([keys, rest])
        counts = np.concatenate([times, np.zeros(len(rest), np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(both), pa.array(counts)], schema=schema)

    none = np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained, others, size = [none], [none], 0
        for batch in batches:
            good = np.array(batch.column("train").to_pylist(), bool)
            for a, b, texts in _slices(batch):
                grams, sizes = _grams(texts)
                mark = np.repeat(good[a:b], sizes)
                trained.append(grams[mark])
                others.append(grams[~mark])
                size += len(grams)
                if size >= _BLOCK:
                    yield summed(trained, others)
                    trained, others, size = [none], [none], 0
        if size:
            yield summed(trained, others)

    return common.lean(run), "gram long, times long"


def _suffix(order: int) -> Column:
    return F.col("gram").bitwiseAND(F.lit((1 << 8 * order) - 1))


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more."""
    row = counts.agg(*[F.count_if(F.col("times") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
    n = [row[f"n{i}"] for i in (1, 2, 3, 4)]
    if 0 in n:  # too little text for the estimate: plain absolute discounting
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    found = [i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)]
    return [min(max(d, 0.05), 0.95 * (i + 1)) for i, d in enumerate(found)]


def model(counts: DataFrame) -> list[DataFrame]:
    """For orders 1 to ORDER: (gram, context, share, left).

    ``share`` is the discounted share of the gram in its context, ``left`` the
    weight its context leaves to the next lower order.  The highest order uses
    counts, lower ones the number of different bytes seen before the gram.
    """
    levels = {ORDER: counts.where("times > 0")}
    for order in range(ORDER - 1, 0, -1):
        levels[order] = levels[order + 1].groupBy(_suffix(order).alias("gram")).agg(F.count("*").alias("times"))
    made = []
    for order in range(1, ORDER + 1):
        level = reliable_copy(levels[order].withColumn("context", F.call_function("shiftright", "gram", F.lit(8))))
        d = _discounts(level)
        contexts = level.groupBy("context").agg(
            F.sum("times").alias("total"),
            sum(F.count_if(F.col("times") == i) * d[i - 1] for i in (1, 2)).alias("few"),
            (F.count_if(F.col("times") >= 3) * d[2]).alias("many"),
        ).select("context", "total", ((F.col("few") + F.col("many")) / F.col("total")).alias("left"))
        taken = F.when(F.col("times") == 1, d[0]).when(F.col("times") == 2, d[1]).otherwise(d[2])
        made.append((
            level.join(contexts, "context").select("gram", ((F.col("times") - taken) / F.col("total")).alias("share")),
            contexts.select("context", "left"),
        ))
    return made


def log_probabilities(counts: DataFrame) -> DataFrame:
    """(gram, nats): minus the log of the interpolated probability of every n-gram.

    Probabilities are made from the shortest n-grams up; each order joins the
    counts of its n-grams and of their contexts.  Unseen bytes share what is left.
    """
    tables = model(counts)
    lower: DataFrame | None = None
    for order, (shares, contexts) in enumerate(tables, start=1):
        grams = counts.select(_suffix(order).alias("gram")).distinct()
        rows = (
            grams.withColumn("context", F.call_function("shiftright", "gram", F.lit(8)))
            .withColumn("shorter", _suffix(order - 1) if order > 1 else F.lit(0).cast("long"))
            .join(shares, "gram", "left")
            .join(contexts, "context", "left")
        )
        if lower is None:
            rows = rows.withColumn("below", F.lit(1.0 / 256))
        else:
            rows = rows.join(lower.select(F.col("gram").alias("shorter"), F.col("p").alias("below")), "shorter")
        p = F.coalesce("share", F.lit(0.0)) + F.coalesce("left", F.lit(1.0)) * F.col("below")
        lower = reliable_copy(rows.select("gram", p.alias("p")))
    return lower.select("gram", (-F.log("p")).cast("float").alias("nats"))


def _scorer(grams: np.ndarray, nats: np.ndarray):
    order = np.argsort(grams)
    shared = (grams[order], np.append(nats[order], np.float32(0)))

    def run_with(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, values = held.value
            for batch in batches:
                sums, counts = [], []
                for _, _, texts in _slices(batch):
                    found, sizes = _grams(texts)
                    at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                    gained = np.where(keys[at] == found, values[at], np.float32(0)).astype(np.float64)
                    ends = np.cumsum(sizes)
                    total = np.append(0.0, np.cumsum(gained))
                    sums.append(total[ends] - total[ends - sizes])
                    counts.append(sizes)
                names = ["doc_id", "text_key", "lang", "held"]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(n) for n in names],
                     pa.array(np.concatenate(sums) if sums else [], pa.float64()),
                     pa.array(np.concatenate(counts) if counts else [], pa.int64())],
                    names=[*names, "nats", "n"])

        return common.lean(run)

    return shared, run_with


def _scored(texts: DataFrame, table: DataFrame) -> DataFrame:
    """Total nats, number of bytes and number of rows of every document.

    One pass for each shard of the table.  Rows that repeat a document are
    counted in ``copies``, whatever the number of shards.
    """
    context = texts.sparkSession.sparkContext
    n = table.count()
    parts = max(1, -(-n // SHARD_ROWS))
    columns = "doc_id long, text_key long, lang string, held boolean, nats double, n long"
    passes = []
    for i in range(parts):
        part = table.where(F.pmod(F.xxhash64("gram"), F.lit(parts)) == i).toArrow()
        grams, nats = (part.column(c).to_numpy() for c in ("gram", "nats"))
        if len(grams) == 0:
            grams, nats = np.array([-1]), np.zeros(1, np.float32)
        shared, run_with = _scorer(grams, nats)
        passes.append(texts.mapInArrow(run_with(context.broadcast(shared)), columns).withColumn("shard", F.lit(i)))
    keys = ["doc_id", "text_key", "lang", "held", "n"]
    each = reduce(DataFrame.unionByName, passes).groupBy(*keys, "shard").agg(
        F.min("nats").alias("nats"), F.count("*").alias("copies"))
    return each.groupBy(*keys).agg(F.sum("nats").alias("nats"), F.max("copies").alias("copies"))


def _quantiles(scores: DataFrame, column: str, share: float, name: str) -> DataFrame:
    """(lang, name): a quantile per language by counting scores in fine steps."""
    bins = scores.groupBy("lang", F.floor(F.col(column) * STEPS).alias("bin")).agg(F.sum("copies").alias("rows"))
    # One row per language and step of a score: bounded by the range of scores.
    lang = Window.partitionBy("lang")
    upto = F.sum("rows").over(lang.orderBy("bin"))
    all_ = F.sum("rows").over(lang)
    return (
        bins.select("lang", "bin", (upto >= F.lit(share) * all_).alias("reached"), all_.alias("n_lang"))
        .where("reached")
        .groupBy("lang")
        .agg(((F.min("bin") + 1) / STEPS).alias(name), F.max("n_lang").alias(f"{name}_n"))
    )


def _threshold(quantile: float) -> Column:
    """The quantile of a language, or of all where the language has too few documents for it.

    A quantile needs 1 / (1 - quantile) documents: with fewer it is their largest
    score.
    """
    enough = F.col("limit_n") * F.lit(1 - quantile) >= 1
    return F.coalesce(F.when(enough, F.col("limit")), "limit_all")


def scores(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, text_key, lang, n_bytes, score, threshold, rejected) of every row.

    ``labels`` holds doc_id and quality; documents with quality 1 are trusted.
    ``score`` is NULL for NULL and empty texts; these are rejected.  Rows with a
    NULL or unknown language, and languages with too few held-out documents for a
    quantile of their own, are held against the quantile of all languages.
    Without any trusted document the threshold is NULL and only empty texts go.
    """
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    trusted = reliable_copy(good.withColumn("trusted", F.lit(True)))
    mark = common.broadcast_if_small(trusted)
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == 0
    texts = (
        docs.select(F.col("doc_id").cast("long"), "text", "lang", F.xxhash64("text").alias("text_key"))
        .join(mark, "doc_id", "left")
        .withColumn("trusted", F.coalesce("trusted", F.lit(False)))
        .select(*common.KEY, "text", "lang", (F.col("trusted") & ~fold).alias("train"), (F.col("trusted") & fold).alias("held"))
    )
    counts = reliable_copy(
        texts.select("text", "train").mapInArrow(*_counter()).groupBy("gram").agg(F.sum("times").alias("times"))
    )
    table = reliable_copy(log_probabilities(counts))
    raw = _scored(texts.select(*common.KEY, "text", "lang", "held"), table)
    mean = reliable_copy(raw.withColumn("mean", F.col("nats") / F.nullif("n", F.lit(0))))
    held = mean.where("held AND mean IS NOT NULL")
    usual = common.broadcast_if_small(_quantiles(held, "mean", 0.5, "usual"))
    every = F.broadcast(_quantiles(held.withColumn("lang", F.lit("")), "mean", 0.5, "usual_all").drop("lang"))

    def drawn(rows: DataFrame) -> DataFrame:
        towards = F.coalesce("usual", "usual_all", "mean")
        score = (F.col("nats") + PRIOR_BYTES * towards) / (F.col("n") + PRIOR_BYTES)
        return rows.join(usual, "lang", "left").join(every, how="left").withColumn(
            "score", F.when(F.col("n") > 0, score))

    settled = reliable_copy(drawn(mean))
    every_row = settled.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    held = settled.where("held AND score IS NOT NULL")
    limit = common.broadcast_if_small(_quantiles(held, "score", quantile, "limit"))
    limit_all = F.broadcast(_quantiles(held.withColumn("lang", F.lit("")), "score", quantile, "limit_all").drop("lang"))
    threshold = _threshold(quantile)
    return every_row.join(limit, "lang", "left").join(limit_all, how="left").select(
        *common.KEY,
        "lang",
        F.col("n").alias("n_bytes"),
        "score",
        threshold.alias("threshold"),
        (F.col("score").isNull() | F.coalesce(F.col("score") > threshold, F.lit(False))).alias("rejected"),
    )


def accepted(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    judged = scores(docs, labels, quantile).where("rejected").select(*common.KEY).distinct()
    gone = reliable_copy(judged)
    rows = common.beside(docs, "doc_id", text_key=F.xxhash64("text"))
    wanted = common.broadcast_if_small(gone)
    return rows.join(wanted, common.same_document(rows, wanted), "left_anti").select("row.*")
