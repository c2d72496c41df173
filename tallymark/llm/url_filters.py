"""URL allow and block rules by a sort-merge range join.

A rule (host, path) becomes the canonical key ``reversed host labels + path``,
for instance ``org.example./es/``: all urls it fits, seen from that host, lie in
the interval of keys that begin with it, and the intervals of two rules are
disjoint or nested.  A url is laid out once per parent domain of its host.  Urls
and rules are sorted together by range; going along, the rule before a url
carries the stack of rules around it, and the rules on that stack that do not
begin the url's key have ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.llm import common

ALLOW, BLOCK = "allow", "block"

# The rules of the registered query.
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """The rules as a table of literals: nothing is sent to Python workers."""
    rows = [F.struct(*[F.lit(x).alias(c) for c, x in zip(("host", "path", "verdict"), rule)]) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lowered; else empty."""
    return common.ascii_lower(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _rule_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): each distinct rule with the rules whose interval holds it.

    Prefixes of the key that are rules themselves; the last is the rule.  Of
    rules with equal host and path, block goes before allow.
    """
    known = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .select(common.ascii_lower(F.col("host")).alias("host"), "path", "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(F.concat(_reversed_host(F.col("host")), "path").alias("key"), "host", "path", "verdict")
    )
    starts = known.select(
        "key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")
    ).select("key", F.substring("key", F.lit(1), F.col("n")).alias("outer_key"))
    outer = known.withColumnRenamed("key", "outer_key")
    return starts.join(outer, "outer_key").groupBy("key").agg(
        F.sort_array(
            F.collect_list(F.struct(F.length("outer_key").alias("n"), "outer_key", "host", "path", "verdict"))
        ).alias("stack")
    )


def _levels(urls: DataFrame) -> DataFrame:
    """One row per (host, path) and parent domain: its canonical key."""
    labels = F.split("host", r"\.")
    return urls.select("host", "path", labels.alias("labels")).select(
        "host", "path", "labels", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("n")
    ).select(
        "host",
        "path",
        F.concat(F.array_join(F.slice(F.reverse("labels"), F.lit(1), F.col("n")), "."), F.lit("."), "path").alias("key"),
    )


def sweep(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule of every distinct (host, path) that any rule fits.

    Columns: host, path, rule (struct of host, path, verdict).  The longest rule
    text wins, between equals the one of the more specific host.
    """
    stacks = _rule_stacks(rules)
    no_stack = F.lit(None).cast(stacks.schema["stack"].dataType)
    starts = stacks.select(
        "key", F.lit(0).alias("kind"), F.lit("").alias("host"), F.lit("").alias("path"), "stack"
    )
    points = _levels(urls).select("key", F.lit(1).alias("kind"), "host", "path", no_stack.alias("stack"))
    order = [F.col("key"), F.col("kind"), F.col("host"), F.col("path")]
    # Equal keys of different hosts may fall into several ranges; the carried
    # stack below makes up for a rule that stayed in an earlier one.
    rows = common.laid_out(points.unionByName(starts), order)
    along = common.within_range(order)
    carried = (
        rows.groupBy("range")
        .agg(F.max(F.when(F.col("kind") == 0, F.struct("key", "stack"))).alias("last"))
        # At most one row per range: the number of partitions bounds this window.
        .select("range", F.last("last", ignorenulls=True).over(
            Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    )
    inside = F.last("stack", ignorenulls=True).over(
        along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    stabbed = (
        rows.withColumn("inside", inside)
        .where(F.col("kind") == 1)
        .join(F.broadcast(carried), "range")
        .withColumn("stack", F.coalesce("inside", F.col("before")["stack"]))
    )
    active = F.filter("stack", lambda r: F.startswith(F.col("key"), r["outer_key"]))
    deepest = F.element_at(active, -1)
    rule_text = F.concat(deepest["host"], deepest["path"])
    return (
        stabbed.where(F.size(active) > 0)
        .select(
            "host",
            "path",
            F.struct(
                F.length(rule_text).alias("n"),
                F.length(deepest["host"]).alias("host_n"),
                deepest["host"].alias("host"),
                deepest["path"].alias("path"),
                deepest["verdict"].alias("verdict"),
            ).alias("rule"),
        )
        .groupBy("host", "path")
        .agg(F.max("rule").alias("rule"))
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """Add host, path, rule and verdict to every row of ``pages``.

    Own columns of those names are replaced.  A NULL url or one without ``://``
    has an empty host and path and no rule.  Rows without a rule get
    ``default``.  Repeated urls are judged once, repeated rows all stay.
    """
    added = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c not in added]
    split = common.beside(pages.select(*kept), host=host_of(F.col("url")), path=path_of(F.col("url")))
    found = sweep(split.select("host", "path").distinct(), rules)
    found = found.select(F.col("host").alias("rule_for_host"), F.col("path").alias("rule_for_path"),
                         F.col("rule").alias("found"))
    return split.join(
        found,
        (F.col("host") == F.col("rule_for_host")) & (F.col("path") == F.col("rule_for_path")),
        "left",
    ).select(
        "row.*",
        "host",
        "path",
        F.concat(F.col("found")["host"], F.col("found")["path"]).alias("rule"),
        F.coalesce(F.col("found")["verdict"], F.lit(default)).alias("verdict"),
    )
