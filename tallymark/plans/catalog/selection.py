"""Splits, tuning and importance, on targets whose answers SQL can state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import encode, explain, split, train, tune
from tallymark.plans.catalog.modelling import outcome_rows, outcome_stages
from tallymark.session import reliable_copy
from tallymark.sources.readers import table

_CHOICES = {"regParam": [0.1, 0.01], "threshold": [0.6, 0.4]}


def _by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a label that is mostly 1, half 1 or mostly 0, by their status alone.

    A model of the status gives chances near 0.9, 0.5 and 0.1, so a threshold of
    0.4 or 0.6 decides what becomes of the middle one.
    """
    digit = F.col("o_orderkey") % 10
    status = F.col("o_orderstatus")
    ones = F.when(status == "F", digit < 9).when(status == "O", digit % 2 == 0).otherwise(digit < 1)
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", ones.cast("double").alias("label"))


def _validated(spark: SparkSession, sf_dir: str) -> tuple[tune.Validated, DataFrame]:
    learn, test = split.split(_by_status(spark, sf_dir), "o_orderkey", [0.7, 0.3])
    features = encode.fit_features(learn, ["o_orderstatus"], [])
    rows, others = (features.transform(x).select("o_orderkey", "label", "features") for x in (learn, test))
    return tune.validate(rows, "o_orderkey", train.estimator("logistic", maxIter=100), _CHOICES), others


def cv_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every combination with its mean over the folds; the best one measured on train and test."""
    found, test = _validated(spark, sf_dir)
    parts = {r["part"]: r["measure"] for r in tune.report(found, test).collect()}
    return found.grid.select(
        "params",
        F.round("measure", 9).alias("measure"),
        "best",
        *[F.when(F.col("best"), F.lit(parts[p])).alias(f"{p}_accuracy") for p in ("train", "test")],
    )


def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir)[0].folds


def cv_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every training row scored by the model that has not seen it."""
    return tune.held_out(_validated(spark, sf_dir)[0], ["o_orderkey", "label"])


def split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return split.with_stratified_part(orders, "o_orderkey", "o_orderpriority", [0.8, 0.15, 0.05])


def permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree finds the label from one column; all others lose nothing when they are shuffled."""
    outcomes = reliable_copy(outcome_rows(spark, sf_dir))
    model = train.fit(outcomes, outcome_stages(), train.estimator("tree", maxDepth=5, seed=7))
    columns = [c for c in outcomes.columns if c not in ("o_orderkey", "label", "o_totalprice")]
    found = explain.permutation_importance(model.transform, outcomes, "o_orderkey", columns)
    return found.select("feature", F.round("measure", 9).alias("measure"), F.round("loss", 9).alias("loss"))


QUERIES = {
    "cv_grid": cv_grid,
    "cv_folds": cv_folds,
    "cv_held_out": cv_held_out,
    "split_stratified": split_stratified,
    "permutation_importance": permutation_importance,
}


def _digits(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


_KEY = "CAST(o_orderkey AS VARCHAR)"
_CV = f"""
    WITH o AS (
      SELECT o_orderkey, o_orderstatus, {_digits(_KEY)} < 3006477107 AS learn,
             CAST({_digits("'fold' || " + _KEY)} % 5 AS INTEGER) AS fold,
             CASE WHEN CASE o_orderstatus WHEN 'F' THEN o_orderkey % 10 < 9 WHEN 'O' THEN o_orderkey % 2 = 0
                       ELSE o_orderkey % 10 < 1 END THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
      FROM orders),
    p(params, threshold, place) AS (VALUES
      ('regParam=0.1, threshold=0.6', 0.6, 1), ('regParam=0.1, threshold=0.4', 0.4, 2),
      ('regParam=0.01, threshold=0.6', 0.6, 3), ('regParam=0.01, threshold=0.4', 0.4, 4)),
    s AS (
      SELECT o.*, p.*, CASE WHEN o_orderstatus = 'F' OR o_orderstatus = 'O' AND threshold < 0.5
                       THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM o, p),
    f AS (
      SELECT params, place, fold, count(*) AS n, avg((label = prediction)::INTEGER) AS measure
      FROM s WHERE learn GROUP BY params, place, fold),
    g AS (SELECT params, place, round(avg(measure), 9) AS measure FROM f GROUP BY params, place),
    best AS (SELECT params FROM g ORDER BY measure DESC, place LIMIT 1)"""

_SHUFFLED = (
    "o_orderpriority", "o_orderstatus", "n_lines", "quantity", "discount", "tax", "n_returned",
)


def _loss(name: str) -> str:
    if name != "n_returned":
        return f"SELECT '{name}' AS feature, 1.0::DOUBLE AS measure, 0.0::DOUBLE AS loss"
    return f"""
        SELECT '{name}', round(m, 9), round(1 - m, 9) FROM (
          SELECT avg(((b.n_returned > 0) = (a.label = 1))::INTEGER) AS m
          FROM placed a JOIN placed b ON a.place = (b.place + 1 + {_digits("'shuffle|n_returned'")} % (b.n - 1)) % b.n)"""


ORACLES = {
    "cv_grid": f"""{_CV}
        SELECT params, measure, params = (FROM best) AS best,
               CASE WHEN params = (FROM best) THEN (SELECT avg((label = prediction)::INTEGER) FROM s
                    WHERE learn AND params = (FROM best)) END AS train_accuracy,
               CASE WHEN params = (FROM best) THEN (SELECT avg((label = prediction)::INTEGER) FROM s
                    WHERE NOT learn AND params = (FROM best)) END AS test_accuracy
        FROM g""",
    "cv_folds": f"{_CV} SELECT params, fold, n, measure FROM f",
    "cv_held_out": f"""{_CV}
        SELECT o_orderkey, label, fold, prediction FROM s WHERE learn AND params = (FROM best)""",
    "split_stratified": f"""
        SELECT o_orderkey, o_orderpriority,
               CAST(CASE WHEN rank <= floor(n * 0.8::DOUBLE + 0.5) THEN 0
                         WHEN rank <= floor(n * (0.8::DOUBLE + 0.15::DOUBLE) + 0.5) THEN 1 ELSE 2 END AS INTEGER) AS part
        FROM (SELECT o_orderkey, o_orderpriority, count(*) OVER (PARTITION BY o_orderpriority) AS n,
                     row_number() OVER (PARTITION BY o_orderpriority
                                        ORDER BY substr(md5({_KEY}), 1, 8), o_orderkey) AS rank FROM orders)""",
    "permutation_importance": f"""
        WITH o AS (SELECT o_orderkey, count(*) FILTER (l_returnflag = 'R') AS n_returned,
                          max((l_returnflag = 'R')::INTEGER) AS label
                   FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey),
        placed AS (SELECT *, count(*) OVER () AS n, row_number() OVER (
                     ORDER BY substr(md5('shuffle' || {_KEY}), 1, 8), o_orderkey) - 1 AS place FROM o)
        SELECT NULL::VARCHAR AS feature, 1.0::DOUBLE AS measure, 0.0::DOUBLE AS loss
        UNION ALL {' UNION ALL '.join(map(_loss, _SHUFFLED))}""",
}
