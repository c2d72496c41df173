"""Set-similarity join of documents over word shingles, by several token orders.

Two sets with a Jaccard similarity of at least T share a token among the first
``n - ceil(T n) + 1`` tokens of each, under any order of all tokens.  The first
order makes the candidates: tokens that are frequent in the corpus come last,
the others go by their hash.  A candidate must then also share a leading token
under two further orders before its sets are intersected.

Equal sets are one node, so copies cost nothing.  The nodes that share leading
tokens are first compared with one of them only, in the middle of its family;
what that links is one component.  Other pairs are made only between
different components that still share a token at places that allow enough common
tokens.  No link is lost: a pair that is skipped lies in one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm import common
from tallymark.llm.components import components
from tallymark.llm.shingles import K, mixed, shingle_sets, signature
from tallymark.session import reliable_copy

PERCENT = 80

# A token seen in so many different sets of one block of tokens may be frequent.
_SEEN = 2
_BLOCK = 4_000_000
# So many frequent tokens at most are put last; the order of the others is their hash.
FREQUENT = 1_000_000
# Rows of frequent tokens are spread over so many tasks.
_SPREAD = 16

_ORDERS = (np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25))
_BYTES = 5  # kept of a token for comparing two sets


def leading(n: int, percent: int) -> int:
    """How many leading tokens of a set of ``n`` must be looked at."""
    return n - -(-percent * n // 100) + 1


def _describe(k: int):
    """One row per document, and rows of tokens that many sets of a block hold."""
    names = ("doc_id", "text_key", "n", "node", "token", "times")
    schema = pa.schema([(name, pa.int64()) for name in names])

    def often(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens, times = np.unique(np.concatenate(held), return_counts=True)
        tokens, times = tokens[times >= _SEEN], times[times >= _SEEN]
        none = pa.nulls(len(tokens), pa.int64())
        return pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(tokens.view(np.int64)), pa.array(times.astype(np.int64))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for batch in batches:
            counts, nodes = [], []
            for tokens in shingle_sets(batch.column("text"), k):
                node = signature(tokens) if len(tokens) else None
                counts.append(len(tokens))
                nodes.append(node)
                if node is not None and node not in seen:
                    seen.add(node)
                    held.append(tokens)
                    size += len(tokens)
                if size >= _BLOCK:
                    yield often(held)
                    held, size, seen = [], 0, set()
            none = pa.nulls(len(counts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64()),
                 pa.array(nodes, pa.int64()), none, none], schema=schema)
        if held:
            yield often(held)

    return common.lean(run), ", ".join(f"{name} long" for name in names)


def _frequent(described: DataFrame) -> np.ndarray:
    """The most frequent tokens, rarest first; FREQUENT rows at most reach the driver."""
    counts = described.where("token IS NOT NULL").groupBy("token").agg(F.sum("times").alias("times"))
    level = F.floor(F.log2("times")).cast("int")
    counts = reliable_copy(counts.withColumn("level", level))
    lowest, total = None, 0
    for row in sorted(counts.groupBy("level").count().collect(), reverse=True):
        total += row["count"]
        if total > FREQUENT:
            break
        lowest = row["level"]
    if lowest is None:
        return np.zeros(0, np.uint64)
    rows = counts.where(F.col("level") >= lowest).select("token", "times").toArrow()
    tokens = rows.column("token").to_numpy().view(np.uint64)
    return tokens[np.lexsort((tokens, rows.column("times").to_numpy()))]


def _first_tokens(frequent: np.ndarray, k: int, percent: int):
    """(token, node, n, place, spread): the leading tokens of every set under the first order.

    ``place`` counts from 1.  Frequent tokens have a number to spread their rows by.
    """
    schema = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("place", pa.int32()),
                        ("spread", pa.int32())])
    by_value = np.argsort(frequent)
    known = frequent[by_value]

    def chosen(tokens: np.ndarray) -> tuple[np.ndarray, int]:
        """Leading tokens; how many of them, at the end, are frequent."""
        p = leading(len(tokens), percent)
        if len(known) == 0:
            return tokens[:p], 0
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        hit = known[at] == tokens
        rare = tokens[~hit][:p]
        if len(rare) == p:
            return rare, 0
        ranks = np.sort(by_value[at[hit]])[: p - len(rare)]
        return np.concatenate([rare, frequent[ranks]]), len(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for tokens in shingle_sets(batch.column("text"), k):
                if len(tokens) == 0:
                    continue
                node = signature(tokens)
                first, often = chosen(tokens)
                spread = np.full(len(first), -1, np.int32)
                spread[len(first) - often :] = node % _SPREAD
                parts.append((first, node, len(tokens), spread))
            if parts:
                sizes = [len(p[0]) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([p[0] for p in parts]).view(np.int64)),
                     pa.array(np.repeat(np.array([p[1] for p in parts], np.int64), sizes)),
                     pa.array(np.repeat(np.array([p[2] for p in parts], np.int32), sizes)),
                     pa.array(np.concatenate([np.arange(1, size + 1, dtype=np.int32) for size in sizes])),
                     pa.array(np.concatenate([p[3] for p in parts]))], schema=schema)

    return common.lean(run), "token long, node long, n int, place int, spread int"


def _sets(k: int):
    schema = pa.schema([("node", pa.int64()), ("tokens", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = [], []
            for tokens in shingle_sets(batch.column("text"), k):
                if len(tokens):
                    nodes.append(signature(tokens))
                    sets.append(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_BYTES].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], schema=schema)

    return common.lean(run), "node long, tokens binary"


def _unpacked(raw: bytes) -> np.ndarray:
    small = np.frombuffer(raw, np.uint8).reshape(-1, _BYTES)
    full = np.zeros((len(small), 8), np.uint8)
    full[:, :_BYTES] = small
    return full.reshape(-1).view("<u8")


def _share_leading(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Both sets share a leading token under each of the further orders."""
    for order in _ORDERS:
        first = []
        for tokens in (a, b):
            ranks, p = mixed(tokens ^ order), leading(len(tokens), percent)
            first.append(np.partition(ranks, p - 1)[:p] if p < len(ranks) else ranks)
        if not np.isin(*first).any():
            return False
    return True


def _linked(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                a, b = _unpacked(x.as_buffer()), _unpacked(y.as_buffer())
                good = _share_leading(a, b, percent)
                if good:
                    both = len(np.intersect1d(a, b))
                    good = 100 * both >= percent * (len(a) + len(b) - both)
                keep.append(good)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], schema=schema)

    return common.lean(run), "a long, b long"


def _verified(pairs: DataFrame, texts: DataFrame, holders: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar enough.

    Sets are made anew for the nodes that occur in a pair, each from one row.
    A set goes along with the pairs of its node a; b is the node with many pairs.
    """
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = reliable_copy(holders.join(nodes, "node", "left_semi").select(*common.KEY))
    some = common.broadcast_if_small(wanted)
    sets = reliable_copy(
        texts.join(some, common.same_document(texts, some), "left_semi").select("text").mapInArrow(*_sets(k))
    )
    x = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    ends = common.broadcast_if_small(reliable_copy(pairs.select("b").distinct()))
    y = y.join(ends, "b", "left_semi")
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(*_linked(percent)).distinct()


def _possible(percent: int):
    """Whether sets of n and m tokens with a common token at these places may be similar.

    Holds for the first common token of every similar pair: what stands before
    it is not shared, so at most the smaller rest is.
    """
    needed = percent * (F.col("n") + F.col("m"))
    return ((100 + percent) * (F.col("n") - F.col("place") + 1) >= needed) & (
        (100 + percent) * (F.col("m") - F.col("place2") + 1) >= needed
    )


def _groups(texts: DataFrame, frequent: np.ndarray, k: int, percent: int) -> DataFrame:
    """(group, node, n, place, tokens): sets of nodes that share leading tokens.

    Tokens with the same nodes are one group; ``place`` is that of the first of
    them, in which every node has its smallest, and ``tokens`` how many they are.
    Rows of a frequent token are spread over several tasks, so it is a group of
    its own.
    """
    nodes = "OVER (PARTITION BY token, spread)"
    # Copies repeat a node's rows for all of its tokens alike, so sums tell node sets apart.
    rows = (
        texts.select("text")
        .mapInArrow(*_first_tokens(frequent, k, percent))
        .withColumn("low", F.expr(f"min(node) {nodes}"))
        .withColumn("high", F.expr(f"max(node) {nodes}"))
        .withColumn("size", F.expr(f"count(*) {nodes}"))
        .withColumn("sum", F.expr(f"sum(pmod(xxhash64(node), {1 << 40})) {nodes}"))
        .where("low < high OR spread >= 0")
    )
    same_nodes = F.xxhash64("low", "high", "size", "sum")
    found = reliable_copy(
        rows.withColumn("often", F.col("spread") >= 0)
        .groupBy("often", F.when(F.col("often"), F.col("token")).otherwise(same_nodes).alias("group"), "node")
        .agg(F.first("n").alias("n"), F.min("place").alias("place"), F.count("*").alias("tokens"))
    )
    often = found.where("often").groupBy("group").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    single = often.where("low = high").select("group", F.lit(True).alias("often"))
    return reliable_copy(found.join(single, ["often", "group"], "left_anti").drop("often"))


def links(docs: DataFrame, described: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between nodes that together give all components."""
    texts = common.keyed(docs, "text")
    groups = _groups(texts, _frequent(described), k, percent)
    # Texts near the middle of a family of copies have most of their tokens in common.
    weights = groups.groupBy("node").agg(F.sum("tokens").alias("weight"))
    middles = groups.join(weights, "node").groupBy("group").agg(
        F.max(F.struct("weight", "node", "n", "place")).alias("end")
    )
    first_pairs = (
        groups.join(middles, "group")
        .where(F.col("node") != F.col("end.node"))
        .withColumns({"m": F.col("end.n"), "place2": F.col("end.place")})
        .where(_possible(percent))
        .select(F.col("node").alias("a"), F.col("end.node").alias("b"))
        .groupBy(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
        .agg(F.min(F.struct("a", "b")).alias("pair"))
        .select("pair.*")
    )
    first_pairs = reliable_copy(first_pairs)
    holders = reliable_copy(
        described.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min(F.struct(*common.KEY)).alias("row"))
        .select("node", "row.*")
    )
    first = reliable_copy(_verified(first_pairs, texts, holders, k, percent))
    known = components(first)
    placed = groups.join(known, "node", "left").select(
        "group", "node", "n", "place", F.coalesce("component", "node").alias("component")
    )
    open_groups = placed.groupBy("group").agg(
        F.min("component").alias("c"), F.max("component").alias("d")
    ).where("c < d").select("group")
    still = reliable_copy(placed.join(open_groups, "group", "left_semi"))
    one = still.select("group", F.col("node").alias("a"), "n", "place", F.col("component").alias("c"))
    other = still.select(
        "group", F.col("node").alias("b"), F.col("n").alias("m"), F.col("place").alias("place2"),
        F.col("component").alias("d"),
    )
    rest = (
        one.join(other, "group")
        .where((F.col("a") < F.col("b")) & (F.col("c") != F.col("d")) & _possible(percent))
        .select("a", "b")
        .distinct()
        .join(first_pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    )
    return first.unionByName(_verified(reliable_copy(rest), texts, holders, k, percent))


def _placed(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, component) of every row; no component without words."""
    keys = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    described = reliable_copy(keys.mapInArrow(*_describe(k)))
    found = components(links(docs, described, k, percent))
    return described.where("token IS NULL").join(found, "node", "left").select(
        *common.KEY, F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component")
    )


def classes(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach, its own included.
    NULL texts and texts without words have no shingles and reach only
    themselves.  Equal texts share a class; NULL ids are never the smallest.
    """
    rows = _placed(docs, k, percent)
    smallest = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(smallest, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: of every class the one with the smallest id.

    Documents without words all stay.  NULL ids come last, different texts under
    one id go by their hash, and a row that is repeated stays once.
    """
    rows = _placed(docs, k, percent)
    first = F.min(F.struct(F.col("doc_id").isNull(), *common.KEY)).alias("first")
    best = rows.where("component IS NOT NULL").groupBy("component").agg(first)
    kept = best.select("first.doc_id", "first.text_key").withColumnsRenamed(
        {"doc_id": "kept_id", "text_key": "kept_key"}
    )
    wordless = rows.where("component IS NULL").select("doc_id", "text_key").distinct()
    own = common.beside(docs, "doc_id", text_key=F.xxhash64("text"))
    match = own["doc_id"].eqNullSafe(kept["kept_id"]) & (own["text_key"] == kept["kept_key"])
    with_words = own.join(kept, match, "left_semi").dropDuplicates(list(common.KEY))
    without = own.join(wordless, common.same_document(own, wordless), "left_semi")
    return with_words.unionByName(without).select("row.*")
