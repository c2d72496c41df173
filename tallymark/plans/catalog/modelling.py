"""Training, tuning, scoring over whole tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Matrices
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.operators import closed_form, encode, split, train
from tallymark.sources import sinks
from tallymark.sources.readers import table

_SEED = 7
_NUMBERS = ("n_lines", "quantity", "discount", "tax", "n_returned")


def outcome_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order that has lines; label 1 when one of them was returned.

    The label follows from ``n_returned``, so a model that works finds it and
    SQL can state the predictions.  Lines are summed per order before the join,
    so each order is one row there.
    """
    returned = F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("n_lines"),
            F.sum("l_quantity").alias("quantity"),
            F.sum("l_discount").alias("discount"),
            F.sum("l_tax").alias("tax"),
            F.sum(returned).alias("n_returned"),
            F.max(returned).alias("label"),
        )
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"
    )
    return orders.join(lines, "o_orderkey")


def _parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return split.split(outcome_rows(spark, sf_dir), "o_orderkey", [0.7, 0.3])


def outcome_stages(numbers: tuple[str, ...] = _NUMBERS, scaled: bool = False) -> list:
    return encode.feature_stages(
        ["o_orderpriority", "o_orderstatus"], numbers, keep_unseen=True, scaled=scaled
    )


def _scored(model, holdout: DataFrame) -> DataFrame:
    return train.score(model, holdout, ["o_orderkey", "label"]).drop("probability")


def _train_and_score(spark: SparkSession, sf_dir: str, kind: str, **params) -> DataFrame:
    learn, holdout = _parts(spark, sf_dir)
    return _scored(train.fit(learn, outcome_stages(), train.estimator(kind, **params)), holdout)


def ols_closed_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    found = closed_form.simple_regression(lines, "l_extendedprice", "l_quantity")
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


def train_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_quantity", F.col("l_extendedprice").alias("label")
    )
    stages = encode.feature_stages([], ["l_quantity"])
    model = train.fit(lines, stages, train.estimator("linear", maxIter=500, regParam=0.0))
    found = train.coefficients(model.stages[-1], ["l_quantity"])
    return found.withColumn("value", F.round("value", 6))


def train_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train_and_score(
        spark, sf_dir, "logistic", maxIter=100, regParam=0.01, threshold=0.6
    )


def train_logistic_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn, holdout = _parts(spark, sf_dir)
    model = train.estimator("logistic", maxIter=100, weightCol="weight")
    weighted = closed_form.balanced_weights(learn, "label")
    return _scored(train.fit(weighted, outcome_stages(), model), holdout)


def train_logistic_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn, holdout = _parts(spark, sf_dir)
    # Every number may only speak for a returned line, never against it.
    bounds = Matrices.dense(1, len(_NUMBERS), [0.0] * len(_NUMBERS))
    model = train.estimator("logistic", maxIter=100, lowerBoundsOnCoefficients=bounds)
    stages = encode.feature_stages([], _NUMBERS)
    return _scored(train.fit(learn, stages, model), holdout)


def logistic_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At its optimum the model expects, per category, as many ones as there are.

    The column that gives the label away is left out, so that there is an optimum.
    """
    outcomes = outcome_rows(spark, sf_dir)
    stages = outcome_stages(tuple(n for n in _NUMBERS if n != "n_returned"))
    model = train.fit(
        outcomes, stages, train.estimator("logistic", maxIter=200, regParam=0.0, tol=1e-12)
    )
    scored = train.score(model, outcomes, ["o_orderpriority"])
    return scored.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("probability")[1]), 2).alias("expected")
    )


def train_decision_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train_and_score(spark, sf_dir, "tree", maxDepth=5, maxBins=32, seed=_SEED)


def _forest(features: str = "8"):
    return train.estimator(
        "forest", numTrees=100, maxDepth=30, impurity="entropy", featureSubsetStrategy=features, seed=_SEED
    )


def train_random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn, holdout = _parts(spark, sf_dir)
    return _scored(train.fit(learn, outcome_stages(), _forest()), holdout)


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees that may look at all features go by the one that gives the label away, and by no other."""
    outcomes = outcome_rows(spark, sf_dir)
    model = train.fit(outcomes, outcome_stages(), _forest(features="all"))
    names = encode.slot_names(model.transform(outcomes))
    return train.importances(model.stages[-1], names)


def train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train_and_score(
        spark, sf_dir, "boosted", maxIter=20, maxDepth=5, stepSize=0.1, seed=_SEED
    )


def _price_model(learn: DataFrame):
    model = train.estimator(
        "boosted_regression", labelCol="o_totalprice", maxIter=10, maxDepth=4, stepSize=0.3,
        subsamplingRate=0.7, featureSubsetStrategy="0.7", minInstancesPerNode=3, seed=_SEED,
    )
    return train.fit(learn, outcome_stages(), model)


def train_gbt_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn, holdout = _parts(spark, sf_dir)
    return train.score(_price_model(learn), holdout, ["o_orderkey", "o_totalprice"])


def boosted_level_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With one category as only feature, boosting must arrive at its level means."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    learn, holdout = split.split(orders, "o_orderkey", [0.7, 0.3])
    indexed = encode.fit_string_index(learn, "o_orderpriority", "priority_index")
    stages = [indexed, *encode.feature_stages([], ["priority_index"])]
    model = train.estimator(
        "boosted_regression", labelCol="o_totalprice", maxIter=3, maxDepth=5, seed=_SEED
    )
    scored = train.score(train.fit(learn, stages, model), holdout, ["o_orderkey"])
    return scored.withColumn("prediction", F.round("prediction", 3))


def blend_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest's chance and a boosted score, averaged.

    Every tree may look at all features, so both find the label.
    """
    learn, holdout = _parts(spark, sf_dir)
    models = {
        "forest_score": train.estimator("forest", numTrees=25, maxDepth=5, featureSubsetStrategy="all", seed=_SEED),
        "boosted_score": train.estimator(
            "boosted_regression", maxIter=10, maxDepth=5, stepSize=0.3, subsamplingRate=0.7,
            featureSubsetStrategy="all", seed=_SEED,
        ),
    }
    outputs = {"forest_score": "probability", "boosted_score": "prediction"}
    fitted = train.fit_several(learn, outcome_stages(), models)
    found = train.blend({name: (fitted[name], outputs[name]) for name in models}, holdout, ["o_orderkey", "label"])
    return found.select("o_orderkey", "label", *[F.round(c, 6).alias(c) for c in (*models, "score")])


def train_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn, holdout = _parts(spark, sf_dir)
    stages = encode.feature_stages([], _NUMBERS, scaled=True)
    layers = train.perceptron_layers(len(_NUMBERS), 2, hidden=[8])
    model = train.estimator(
        "perceptron", layers=layers, maxIter=60, blockSize=30, tol=1e-5, seed=_SEED
    )
    return _scored(train.fit(learn, stages, model), holdout)


def train_linear_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train_and_score(spark, sf_dir, "svm", maxIter=100, regParam=0.01)


def train_naive_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn, holdout = _parts(spark, sf_dir)
    model = train.estimator("bayes", smoothing=1.0, modelType="multinomial")
    fitted = train.fit(learn, encode.feature_stages([], _NUMBERS), model)
    scored = train.score(fitted, holdout, ["o_orderkey", "label"])
    return scored.withColumn("probability", F.round(F.col("probability")[1], 6))


def naive_bayes_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    features = ["l_quantity", "l_discount", "l_tax"]
    found = closed_form.naive_bayes(lines, "l_returnflag", features)
    return found.withColumn("value", F.round("value", 6))


def train_one_vs_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The class number follows from the priority, so predictions must equal it.
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        "o_orderstatus",
        "o_totalprice",
        (F.substring("o_orderpriority", 1, 1).cast("double") - 1).alias("label"),
    )
    learn, holdout = split.split(orders, "o_orderkey", [0.7, 0.3])
    features = encode.fit_features(
        learn, ["o_orderpriority", "o_orderstatus"], ["o_totalprice"], keep_unseen=True
    )
    rows = features.transform(learn).select("label", "features")
    model = train.fit_one_vs_rest(rows, train.estimator("logistic", maxIter=100, regParam=0.01))
    scored = train.score_one_vs_rest(model, features.transform(holdout), ["o_orderkey", "label"])
    return scored.drop("probability")


def train_gbt_multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )
    learn, holdout = split.split(rows, "vec_id", [0.7, 0.3])
    model = train.fit_one_vs_rest(
        learn, train.estimator("boosted", maxIter=3, maxDepth=3, stepSize=0.1, seed=_SEED)
    )
    scored = train.score_one_vs_rest(model, holdout, ["vec_id", "label"])
    return scored.withColumn("probability", F.round(F.array_max("probability"), 6))


def gbt_multiclass_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted one-vs-rest over five classes that follow from one category.

    Every round moves all rows of a class by the same step, so the margins after
    25 rounds, and the chances they give, are known.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus",
        (F.substring("o_orderpriority", 1, 1).cast("double") - 1).alias("label"),
    )
    learn, holdout = split.split(orders, "o_orderkey", [0.7, 0.3])
    features = encode.fit_features(learn, ["o_orderpriority", "o_orderstatus"], [], keep_unseen=True)
    model = train.fit_one_vs_rest(
        features.transform(learn).select("label", "features"),
        train.estimator("boosted", maxIter=25, maxDepth=15, stepSize=0.1, seed=_SEED),
    )
    scored = train.score_one_vs_rest(model, features.transform(holdout), ["o_orderkey", "label"])
    return scored.withColumn("probability", F.round(F.array_max("probability"), 6))


def training_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every history of a two-class fit must show.

    It starts at the labels' entropy, where the intercept alone speaks, has one
    step per iteration, and never rises.
    """
    model = train.fit(
        outcome_rows(spark, sf_dir), outcome_stages(), train.estimator("logistic", maxIter=100)
    ).stages[-1]
    steps = train.training_history(model)
    # As many rows as iterations, so a window over them is small.
    before = F.lag("objective").over(Window.orderBy("iteration"))
    return steps.withColumn("rise", F.coalesce(F.col("objective") > before, F.lit(False))).agg(
        F.round(F.min_by("objective", "iteration"), 9).alias("first_objective"),
        (F.count(F.lit(1)) == model.summary.totalIterations + 1).alias("one_per_iteration"),
        (~F.bool_or("rise")).alias("never_rises"),
    )


def score_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn, holdout = _parts(spark, sf_dir)
    model = train.fit(learn, outcome_stages(scaled=True), train.estimator("logistic", maxIter=100))
    scored = train.score(model, holdout.drop("label"), ["o_orderkey"])
    return sinks.submission(scored, "o_orderkey")


QUERIES = {
    "ols_closed_form": ols_closed_form,
    "train_linear": train_linear,
    "train_logistic": train_logistic,
    "train_logistic_weighted": train_logistic_weighted,
    "train_logistic_bounded": train_logistic_bounded,
    "logistic_balance": logistic_balance,
    "train_decision_tree": train_decision_tree,
    "train_random_forest": train_random_forest,
    "feature_importance": feature_importance,
    "train_gbt": train_gbt,
    "train_gbt_regressor": train_gbt_regressor,
    "boosted_level_means": boosted_level_means,
    "blend_models": blend_models,
    "train_mlp": train_mlp,
    "train_linear_svc": train_linear_svc,
    "train_naive_bayes": train_naive_bayes,
    "naive_bayes_params": naive_bayes_params,
    "train_one_vs_rest": train_one_vs_rest,
    "train_gbt_multiclass": train_gbt_multiclass,
    "gbt_multiclass_margins": gbt_multiclass_margins,
    "training_history": training_history,
    "score_holdout": score_holdout,
}

_LINE = "FROM lineitem"
_SUMS = ("l_quantity", "l_discount", "l_tax")
_MASS = " + ".join(f"sum({c})" for c in _SUMS)


def _bayes_row(term: str, value: str) -> str:
    return f"""SELECT l_returnflag AS label, '{term}' AS term, round({value}, 6) AS value
               FROM lineitem GROUP BY l_returnflag"""


_OUTCOMES = """
    (SELECT o_orderkey, count(*) AS n_lines, sum(l_quantity) AS quantity,
            sum(l_discount) AS discount, sum(l_tax) AS tax,
            count(*) FILTER (l_returnflag = 'R') AS n_returned,
            max(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS label,
            substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) < 'b3333333' AS learn
     FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey)"""


def _log_share(label: int, feature: str) -> str:
    return f"""(SELECT ln(sum({feature}) + 1)
                - ln({' + '.join(f'sum({f})' for f in _NUMBERS)} + {len(_NUMBERS)})
                FROM o WHERE learn AND label = {label})"""


def _log_joint(label: int) -> str:
    prior = f"""(SELECT ln(count(*) FILTER (label = {label}) + 1) - ln(count(*) + 2)
                 FROM o WHERE learn)"""
    return " + ".join([prior, *[f"{f} * {_log_share(label, f)}" for f in _NUMBERS]])


_RECOVERED = f"SELECT o_orderkey, label, label AS prediction FROM {_OUTCOMES} WHERE NOT learn"

_SLOTS = """
    (SELECT 'o_orderpriority_vec_' || o_orderpriority AS feature FROM (SELECT DISTINCT o_orderpriority FROM orders)
     UNION ALL SELECT 'o_orderstatus_vec_' || o_orderstatus FROM (SELECT DISTINCT o_orderstatus FROM orders)
     UNION ALL SELECT unnest(['n_lines', 'quantity', 'discount', 'tax', 'n_returned']))"""

ORACLES = {
    "feature_importance": f"""
        SELECT feature, CASE WHEN feature = 'n_returned' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance
        FROM {_SLOTS}""",
    "blend_models": f"""
        SELECT o_orderkey, label, label AS forest_score, label AS boosted_score, label AS score
        FROM {_OUTCOMES} WHERE NOT learn""",
    "gbt_multiclass_margins": """
        WITH RECURSIVE f(round, margin) AS (
          SELECT 1, 1.0::DOUBLE
          UNION ALL SELECT round + 1, margin + 0.1::DOUBLE * 4 / (1 + exp(2 * margin)) FROM f WHERE round < 25),
        o AS (SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) - 1 AS label FROM orders
              WHERE substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) >= 'b3333333')
        SELECT o_orderkey, label, label AS prediction,
               (SELECT round(1 / (1 + 4 * exp(-2 * margin)), 6) FROM f WHERE round = 25) AS probability FROM o""",
    "train_logistic": _RECOVERED,
    "train_logistic_weighted": _RECOVERED,
    "train_logistic_bounded": _RECOVERED,
    "train_decision_tree": _RECOVERED,
    "train_random_forest": _RECOVERED,
    "train_gbt": _RECOVERED,
    "train_mlp": _RECOVERED,
    "train_linear_svc": _RECOVERED,
    "train_one_vs_rest": """
        SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) - 1 AS label,
               CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) - 1 AS prediction
        FROM orders WHERE substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) >= 'b3333333'""",
    "score_holdout": f"""
        SELECT o_orderkey AS "ID", CASE WHEN label = 1 THEN 'pass' ELSE 'fail' END AS y
        FROM {_OUTCOMES} WHERE NOT learn""",
    "training_history": f"""
        SELECT round(-(p * ln(p) + (1 - p) * ln(1 - p)), 9) AS first_objective,
               true AS one_per_iteration, true AS never_rises
        FROM (SELECT avg(label) AS p FROM {_OUTCOMES})""",
    "ols_closed_form": f"""
        SELECT round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
               round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
               round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 {_LINE}""",
    "train_linear": f"""
        SELECT 'intercept' AS term,
               round(regr_intercept(l_extendedprice, l_quantity), 6) AS value {_LINE}
        UNION ALL SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 6) {_LINE}""",
    "logistic_balance": f"""
        SELECT o_orderpriority, count(*) AS n, round(sum(label), 2) AS expected
        FROM {_OUTCOMES} JOIN orders USING (o_orderkey) GROUP BY o_orderpriority""",
    "boosted_level_means": """
        WITH o AS (SELECT *, substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) < 'b3333333' AS learn
                   FROM orders),
        m AS (SELECT o_orderpriority, avg(o_totalprice) AS mean FROM o WHERE learn
              GROUP BY o_orderpriority)
        SELECT o_orderkey, round(mean, 3) AS prediction
        FROM o JOIN m USING (o_orderpriority) WHERE NOT learn""",
    "train_naive_bayes": f"""
        WITH o AS MATERIALIZED {_OUTCOMES},
        s AS (SELECT o_orderkey, label, {_log_joint(1)} AS one, {_log_joint(0)} AS zero
              FROM o WHERE NOT learn)
        SELECT o_orderkey, label,
               CASE WHEN one > zero THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
               round(1 / (1 + exp(zero - one)), 6) AS probability
        FROM s""",
    "naive_bayes_params": " UNION ALL ".join(
        [_bayes_row("pi", """ln(count(*) + 1) - ln((SELECT count(*) FROM lineitem)
             + (SELECT count(DISTINCT l_returnflag) FROM lineitem))""")]
        + [_bayes_row(c, f"ln(sum({c}) + 1) - ln({_MASS} + 3)") for c in _SUMS]
    ),
}
