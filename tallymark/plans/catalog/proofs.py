"""Models in closed form, and what must hold for fitted ones, with SQL that says the same."""

from __future__ import annotations

from pyspark.ml.linalg import Matrices, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.labels import class_by_thresholds
from tallymark.operators import closed_form, encode, explain, train
from tallymark.plans.catalog.modelling import outcome_rows, outcome_stages
from tallymark.sources.readers import table

_FLAGS = ("big", "cheap", "late", "taxed")
_NOISY = ("n_lines", "quantity", "discount", "tax")


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as 0/1 features; a line is weighted by its number in the order."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_returnflag",
        (F.ascii("l_returnflag") - 64).cast("double").alias("label"),
        (F.col("l_quantity") > 30).cast("int").alias("big"),
        (F.col("l_extendedprice") < 20000).cast("int").alias("cheap"),
        (F.year("l_shipdate") >= 1995).cast("int").alias("late"),
        (F.col("l_tax") > 0.04).cast("int").alias("taxed"),
        F.col("l_linenumber").cast("double").alias("weight"),
    )


def naive_bayes_bernoulli(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = closed_form.bernoulli_bayes(_flags(spark, sf_dir), "l_returnflag", _FLAGS, "weight")
    return found.withColumn("value", F.round("value", 6))


def naive_bayes_bernoulli_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of line with its class and the chances of the classes."""
    lines = _flags(spark, sf_dir)
    model = closed_form.bernoulli_bayes(lines, "label", _FLAGS, "weight")
    kinds = lines.select(*_FLAGS).distinct()
    scored = closed_form.score_bernoulli(model, kinds, _FLAGS, _FLAGS)
    return scored.select(
        *_FLAGS, "prediction", *[F.round(F.get("probability", F.lit(i)), 6).alias(f"p{i}") for i in range(3)]
    )


def class_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of three scores by two lists of thresholds, one with a zero."""
    parts = [F.col("o_custkey") % 4, F.col("o_orderkey") % 5, 1 + F.col("o_custkey") % 3]
    total = (parts[0] + parts[1] + parts[2]).cast("double")
    chances = F.array(*[p / total for p in parts])
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        class_by_thresholds(chances, [0.5, 0.3, 0.2]).alias("by_all"),
        class_by_thresholds(chances, [0.0, 0.6, 0.4]).alias("by_two"),
    )


def logistic_bounded_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At the optimum under bounds the loss is flat where a coefficient is free.

    Lines and quantity speak for a returned line, so an upper bound of 0 holds
    them; the other two are free within bounds they do not reach.
    """
    outcomes = outcome_rows(spark, sf_dir).select("o_orderkey", "label", *_NOISY)
    upper = Matrices.dense(1, 4, [0.0, 0.0, 1e6, 1e6])
    model = train.estimator(
        "logistic", maxIter=1000, tol=1e-14, upperBoundsOnCoefficients=upper,
        lowerBoundsOnIntercepts=Vectors.dense([-1e6]),
    )
    fitted = train.fit(outcomes, encode.feature_stages([], _NOISY), model)
    slopes = explain.logistic_gradient(train.score(fitted, outcomes, ["label", *_NOISY]), "label", _NOISY)
    held = train.coefficients(fitted.stages[-1], _NOISY).select(
        "term", (F.col("term").isin("n_lines", "quantity") & (F.col("value") > -1e-9)).alias("at_bound")
    )
    optimal = F.when(F.col("at_bound"), F.col("gradient") < 1e-5).otherwise(F.abs("gradient") < 1e-5)
    return held.join(slopes, "term").select("term", "at_bound", optimal.alias("optimal"))


def logistic_weighted_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weighted sum of chances of every category is that of its labels."""
    outcomes = outcome_rows(spark, sf_dir).withColumn("weight", 1.0 + F.col("o_orderkey") % 3)
    model = train.estimator("logistic", maxIter=300, regParam=0.0, tol=1e-13, weightCol="weight")
    fitted = train.fit(outcomes, outcome_stages(_NOISY), model)
    scored = train.score(fitted, outcomes, ["o_orderpriority", "weight"])
    return scored.groupBy("o_orderpriority").agg(
        F.round(F.sum(F.col("weight") * F.col("probability")[1]), 2).alias("expected")
    )


def ols_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    found = closed_form.linear_regression(lines, "l_extendedprice", ["l_quantity", "l_discount"])
    return found.select("term", F.round("value", 4).alias("value"), F.round("std_error", 4).alias("std_error"))


def tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree that finds returned orders: a root and two leaves, with their rows."""
    outcomes = outcome_rows(spark, sf_dir)
    fitted = train.fit(outcomes, outcome_stages(), train.estimator("tree", maxDepth=5, seed=7))
    found = explain.tree_table(fitted.stages[-1], encode.slot_names(fitted.transform(outcomes)))
    return found.select("tree", "node", "parent", "side", "depth", "feature", "prediction", "rows")


def monomials(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    products = encode.monomials(["p_size", "p_retailprice"], 3)
    cells = [F.struct(F.lit(name).alias("term"), F.round(p, 4).alias("value")) for name, p in products.items()]
    return parts.select("p_partkey", F.inline(F.array(*cells)))


QUERIES = {
    "naive_bayes_bernoulli": naive_bayes_bernoulli,
    "naive_bayes_bernoulli_scores": naive_bayes_bernoulli_scores,
    "class_thresholds": class_thresholds,
    "logistic_bounded_optimum": logistic_bounded_optimum,
    "logistic_weighted_optimum": logistic_weighted_optimum,
    "ols_many": ols_many,
    "tree_nodes": tree_nodes,
    "monomials": monomials,
}

_F = """(SELECT l_returnflag, (l_quantity > 30)::INTEGER AS big, (l_extendedprice < 20000)::INTEGER AS cheap,
    (year(l_shipdate) >= 1995)::INTEGER AS late, (l_tax > 0.04)::INTEGER AS taxed, l_linenumber::DOUBLE AS weight FROM lineitem)"""


def _bernoulli(flag: str, there: str) -> str:
    return f"""UNION ALL SELECT l_returnflag, '{flag}', {there}, ln(sum(CASE WHEN {flag} = {int(there == 'true')} THEN weight ELSE 0 END) + 1)
        - ln(sum(weight) + 2) FROM f GROUP BY l_returnflag"""


_BERNOULLI = f"""
    f AS MATERIALIZED {_F},
    m AS MATERIALIZED (
      SELECT l_returnflag AS label, 'pi' AS term, NULL::BOOLEAN AS present,
             ln(sum(weight) + 1) - ln((SELECT sum(weight) + count(DISTINCT l_returnflag) FROM f)) AS value
      FROM f GROUP BY l_returnflag {' '.join(_bernoulli(x, t) for x in _FLAGS for t in ('true', 'false'))})"""


def _quotient(i: int, t: float) -> str:
    if t:
        return f"c{i} / {t}::DOUBLE"
    return f"CASE WHEN c{i} > 0 THEN 'inf'::DOUBLE ELSE -1.0 END"


def _class(thresholds: tuple[float, ...]) -> str:
    quotients = ", ".join(_quotient(i, t) for i, t in enumerate(thresholds))
    return f"(list_position([{quotients}], list_max([{quotients}])) - 1)::DOUBLE"


_LINES = """(SELECT o_orderkey, max((l_returnflag = 'R')::INTEGER) AS label, o_orderpriority
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderpriority)"""

ORACLES = {
    "naive_bayes_bernoulli": f"WITH {_BERNOULLI} SELECT label, term, present, round(value, 6) AS value FROM m",
    "naive_bayes_bernoulli_scores": f"""
        WITH {_BERNOULLI},
        k AS (SELECT DISTINCT big, cheap, late, taxed FROM f),
        s AS (SELECT big, cheap, late, taxed, ascii(label) - 64 AS label, sum(value) AS evidence
              FROM k JOIN m ON term = 'pi' {' '.join(f"OR term = '{x}' AND present = ({x} = 1)" for x in _FLAGS)}
              GROUP BY ALL),
        p AS (SELECT *, exp(evidence) / sum(exp(evidence)) OVER (PARTITION BY big, cheap, late, taxed) AS p,
                     row_number() OVER (PARTITION BY big, cheap, late, taxed ORDER BY label) - 1 AS place FROM s)
        SELECT big, cheap, late, taxed, arg_max(label, evidence)::DOUBLE AS prediction,
               {', '.join(f"round(max(p) FILTER (place = {i}), 6) AS p{i}" for i in range(3))}
        FROM p GROUP BY big, cheap, late, taxed""",
    "class_thresholds": f"""
        SELECT o_orderkey, {_class((0.5, 0.3, 0.2))} AS by_all, {_class((0.0, 0.6, 0.4))} AS by_two
        FROM (SELECT o_orderkey, a / n AS c0, b / n AS c1, c / n AS c2
              FROM (SELECT *, (a + b + c)::DOUBLE AS n FROM (
                SELECT o_orderkey, o_custkey % 4 AS a, o_orderkey % 5 AS b, 1 + o_custkey % 3 AS c FROM orders)))""",
    "logistic_bounded_optimum": """
        SELECT * FROM (VALUES ('intercept', false, true), ('n_lines', true, true), ('quantity', true, true),
                              ('discount', false, true), ('tax', false, true)) AS t(term, at_bound, optimal)""",
    "logistic_weighted_optimum": f"""
        SELECT o_orderpriority, round(sum((1.0::DOUBLE + o_orderkey % 3) * label), 2) AS expected
        FROM {_LINES} GROUP BY o_orderpriority""",
    "ols_many": """
        WITH s AS (
          SELECT count(*)::DOUBLE AS n, avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2,
                 var_pop(l_extendedprice) AS yy, var_pop(l_quantity) AS s11, var_pop(l_discount) AS s22,
                 covar_pop(l_quantity, l_discount) AS s12, covar_pop(l_extendedprice, l_quantity) AS y1,
                 covar_pop(l_extendedprice, l_discount) AS y2 FROM lineitem),
        b AS (SELECT *, s11 * s22 - s12 * s12 AS det, (y1 * s22 - y2 * s12) / (s11 * s22 - s12 * s12) AS b1,
                     (y2 * s11 - y1 * s12) / (s11 * s22 - s12 * s12) AS b2 FROM s),
        e AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0, yy - b1 * y1 - b2 * y2 AS rest,
                     (yy - b1 * y1 - b2 * y2) / (n - 3) AS v FROM b)
        SELECT 'intercept' AS term, round(b0, 4) AS value,
               round(sqrt(v * (1 + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / det)), 4) AS std_error FROM e
        UNION ALL SELECT 'l_quantity', round(b1, 4), round(sqrt(v * s22 / det), 4) FROM e
        UNION ALL SELECT 'l_discount', round(b2, 4), round(sqrt(v * s11 / det), 4) FROM e
        UNION ALL SELECT 'r2', round(1 - rest / yy, 4), NULL FROM e
        UNION ALL SELECT 'n', n, NULL FROM e""",
    "tree_nodes": f"""
        SELECT 0 AS tree, node, parent, side, depth, feature, prediction, rows FROM (
          SELECT 0 AS node, NULL::INTEGER AS parent, NULL AS side, 0 AS depth, 'n_returned' AS feature,
                 (2 * sum(label) > count(*))::INTEGER::DOUBLE AS prediction, count(*) AS rows FROM {_LINES}
          UNION ALL SELECT 1, 0, 'left', 1, NULL, 0.0::DOUBLE, count(*) FROM {_LINES} WHERE label = 0
          UNION ALL SELECT 2, 0, 'right', 1, NULL, 1.0::DOUBLE, count(*) FROM {_LINES} WHERE label = 1)""",
    "monomials": " UNION ALL ".join(
        f"SELECT p_partkey, '{'*'.join(names)}' AS term, round({' * '.join(n + '::DOUBLE' for n in names)}, 4) AS value FROM part"
        for names in (
            ("p_size",), ("p_retailprice",), ("p_size", "p_size"), ("p_size", "p_retailprice"), ("p_retailprice", "p_retailprice"),
            ("p_size", "p_size", "p_size"), ("p_size", "p_size", "p_retailprice"), ("p_size", "p_retailprice", "p_retailprice"),
            ("p_retailprice", "p_retailprice", "p_retailprice"),
        )
    ),
}
