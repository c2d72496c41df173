"""The registered queries of the text operators, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import (
    chat,
    collocations,
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
from tallymark.llm.common import read


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filters.judge(pages, url_filters.rule_table(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(read(spark, sf_dir, "documents"))


# A conversation whose texts hold the template's control strings.
_CONTROL = r"\### Assistant: </turn> ok"


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(-7, 0, "user", _CONTROL), (-7, 1, "assistant", _CONTROL)], given.schema
    )
    return chat.digests(chat.format_records(chat.records_of_turns(given.unionByName(added))))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select("doc_id", "lang", "n_bytes", "score", "threshold", "rejected")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fingerprints.edited_pairs(read(spark, sf_dir, "documents"))
    return pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text("chosen").alias("fingerprint"),
        fingerprints.as_text("edited_chosen").alias("edited_fingerprint"),
        fingerprints.likeness("chosen", "edited_chosen").alias("near_edited"),
        fingerprints.likeness("chosen", "next_chosen").alias("near_next"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = toxicity.learned(documents, read(spark, sf_dir, "labels").where(~held_out))
    return toxicity.scored(documents, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicated(documents).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    secrets = F.col("secrets")
    base = F.filter(secrets, lambda x: x["kind"] != "literal")
    return found.select(
        "doc_id",
        *[secret_scan.of_kind(secrets, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secret_scan.as_text(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.as_text(secrets).alias("spans"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(read(spark, sf_dir, "documents"))
    return collocations.top(found).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_decontamination": op4_decontamination,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_fingerprints": op7_fingerprints,
    "op8_toxicity": op8_toxicity,
    "op9_license_scan": op9_license_scan,
    "op10_line_dedup": op10_line_dedup,
    "op11_secret_scan": op11_secret_scan,
    "op12_collocations": op12_collocations,
    "op13_variants": op13_variants,
}

# The same places, counted by comparing every 13-word run of every document.
_OP4 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s + 1 : s + least(len(w), 13)], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 12, 1))) AS s FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, s, array_to_string(w[s + 1 : s + n], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)
), m AS (SELECT doc_id, item_id, s, n FROM dw JOIN bw USING (n, phrase)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM m)) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM m) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

_OP1 = r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3 :] ELSE '' END AS rest FROM pages
), u AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), r(h, p, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), best AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM u) JOIN r
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN best USING (host, path)
"""

_OP2 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 5], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS MATERIALIZED (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

# A template text is ``### role: text</turn>`` and a line end for each turn.
_OP3 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>') AS body,
         replace(replace(replace(replace(role, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>'), ':', '\:') AS head
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(head) + length(body) + 14)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

_OP12 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0),
t AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM s),
f AS MATERIALIZED (
  SELECT lang, 1 AS k, x AS phrase, count(*) AS n FROM t GROUP BY ALL
  UNION ALL SELECT lang, 2, x || ' ' || y, count(*) FROM t WHERE y IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z, count(*) FROM t WHERE z IS NOT NULL GROUP BY ALL
),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
parts AS MATERIALIZED (
  SELECT lang, phrase, a, 1 AS i, w[1] AS head, array_to_string(w[2 : k], ' ') AS rest FROM c
  UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM c WHERE k = 3
), cut AS (
  SELECT parts.lang, parts.phrase, a, i, x.n AS l, y.n AS r,
         (1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n::HUGEINT) AS score
  FROM parts JOIN f x ON x.lang = parts.lang AND x.phrase = head
  JOIN f y ON y.lang = parts.lang AND y.phrase = rest
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
), inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(w[1 : 2], ' ') AS phrase FROM c WHERE k = 3
    UNION ALL SELECT lang, a, array_to_string(w[2 : 3], ' ') FROM c WHERE k = 3) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM best LEFT JOIN inside USING (lang, phrase) JOIN totals USING (lang)
WHERE longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000
"""

# The checksum is spelled out: a table of 256 steps, then one step a byte.
_OP13 = r"""
WITH RECURSIVE tab AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(i::UBIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM range(256) AS r(i)
), r AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL
), b AS (
  SELECT doc_id, run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda x:
    CASE WHEN unicode(x) < 128 THEN [unicode(x)::UBIGINT]
         ELSE [192 + (unicode(x) >> 6)::UBIGINT, 128 + (unicode(x) % 64)::UBIGINT] END)) AS bytes
  FROM r
), h AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::UBIGINT, bytes),
    lambda c, x: xor(c >> 8, tab[(xor(c, x) % 256 + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS h
  FROM b, tab
), v AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), del AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)
), near AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM del a JOIN del b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT del.word, del.n, v.word, v.n FROM del JOIN v ON del.rest = v.word
  UNION SELECT v.word, v.n, del.word, del.n FROM del JOIN v ON del.rest = v.word
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS form_n,
         min(other) FILTER (other_n = (SELECT max(other_n) FROM near y WHERE y.word = near.word)) AS form
  FROM near GROUP BY word
), f AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN form_n >= 10 * n THEN form END AS form, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
  FROM v LEFT JOIN best USING (word)
), way(word, here, step) AS (
  SELECT word, word, 0 FROM f
  UNION ALL SELECT way.word, f.form, step + 1 FROM way JOIN f ON f.word = way.here WHERE f.form IS NOT NULL
)
SELECT f.word, form, root, n, n_near, form_n
FROM f JOIN (SELECT word, arg_max(here, step) AS root FROM way GROUP BY word) USING (word)
"""

ORACLES = {
    "op13_variants": _OP13,
    "op12_collocations": _OP12,
    "op3_chat_formatting": _OP3,
    "op2_jaccard_join": _OP2,
    "op1_url_filters": _OP1,
    "op4_decontamination": _OP4,
}
