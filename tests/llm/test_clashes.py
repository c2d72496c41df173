"""Operators with tables whose own columns bear the names that operators use inside."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallymark.llm import (
    collocations,
    common,
    decontaminate,
    fingerprints,
    jaccard,
    licenses,
    line_dedup,
    packing,
    quality,
    secret_scan,
    toxicity,
    url_filters,
    variants,
)

NAMES = (
    "text_key nos lines stay done found rule_for_host rule_for_path toxic node copies row labelled_id kept_id kept_key "
    "wanted line terms words n key at start length score range group token stack bucket phrase word secrets trusted held"
).split()


@pytest.fixture(scope="module")
def docs(spark):
    common.on_workers(spark)
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    return rows.select("*", *[F.concat(F.lit(name), F.col("doc_id").cast("string")).alias(name) for name in NAMES])


def table(spark, name):
    return spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


@pytest.mark.parametrize("operator", ["op2", "op4", "op6", "op10"])
def test_own_columns_come_back(spark, docs, operator):
    kept = {
        "op2": lambda: jaccard.one_of_each(docs),
        "op4": lambda: decontaminate.clean(docs, table(spark, "benchmark")),
        "op6": lambda: quality.accepted(docs, table(spark, "labels")),
        "op10": lambda: line_dedup.deduplicated(docs),
    }[operator]()
    rows = kept.select("doc_id", *NAMES).collect()
    assert rows and all(r[name] == f"{name}{r.doc_id}" for r in rows for name in NAMES)


def test_own_columns_of_pages_come_back(spark):
    pages = table(spark, "pages").select("page_id", "url")
    named = pages.select("*", *[F.concat(F.lit(name), F.col("page_id").cast("string")).alias(name) for name in NAMES])
    rules = url_filters.rule_table(spark)
    judged = url_filters.judge(named, rules)
    assert judged.columns == [*named.columns, "host", "path", "rule", "verdict"]
    rows = judged.collect()
    assert all(r[name] == f"{name}{r.page_id}" for r in rows for name in NAMES)
    plain = url_filters.judge(pages, rules).collect()
    assert sorted(map(str, plain)) == sorted(str(r) for r in judged.select(*plain[0].asDict()).collect())


def test_other_names_change_no_result(spark, docs):
    plain = docs.select("doc_id", "text", "lang")
    labels = table(spark, "labels")
    path = public_tokenizers.path("word_bpe_49k.json")
    for f in (
        jaccard.classes,
        licenses.scan,
        lambda d: fingerprints.edited_pairs(d).select("doc_id", "chosen"),
        lambda d: toxicity.scored(d, toxicity.learned(d, labels)),
        lambda d: packing.pack(d.coalesce(1), path).select("doc_id", "start", "length"),
        lambda d: quality.scores(d, labels).select("doc_id", "score"),
        secret_scan.scan,
        collocations.collocations,
        variants.variants,
    ):
        assert sorted(map(str, f(docs).collect())) == sorted(map(str, f(plain).collect()))


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_conflicting_labels(spark, partitions):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    labels = docs.select("doc_id", F.lit(0).alias("toxic")).union(docs.select("doc_id", F.lit(1).alias("toxic")))
    sample = toxicity.labelled_sample(docs, labels.repartition(partitions))
    assert sample.where("toxic = 1").count() == 40 == sample.count()
