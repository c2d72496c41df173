"""Fitting, tuning and scoring models with ``pyspark.ml``.

A model is trained on a table and gives a ``PipelineModel``; scoring returns
plain columns.  Feature stages are part of the pipeline, so they are fitted on
the training table only and reused as they are on every other table.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.labels import agreeing_threshold, best_class, mean_of, softmax
from tallymark.operators.split import with_fold
from tallymark.session import reliable_copy

ESTIMATORS = {
    "linear": LinearRegression,
    "logistic": LogisticRegression,
    "tree": DecisionTreeClassifier,
    "forest": RandomForestClassifier,
    "boosted": GBTClassifier,
    "boosted_regression": GBTRegressor,
    "perceptron": MultilayerPerceptronClassifier,
    "svm": LinearSVC,
    "bayes": NaiveBayes,
}


def estimator(kind: str, **params: Any) -> Estimator:
    """An unfitted model by name; ``params`` are those of the ``pyspark.ml`` class.

    A ``threshold`` and ``thresholds`` that state different things are refused.
    """
    agreeing_threshold(params.get("threshold"), params.get("thresholds"))
    return ESTIMATORS[kind](**params)


@contextmanager
def ready(df: DataFrame, in_memory: bool = False) -> Iterator[DataFrame]:
    """A training table that an iterative fit may read many times.

    By default a copy in the checkpoint folder: what made the table runs once,
    tasks carry no history of it, and lost executors cost nothing.  With
    ``in_memory`` it is persisted instead (to disk where memory is short) and
    released afterwards, for tables that are cheap to make again.
    """
    if not in_memory:
        yield reliable_copy(df)
        return
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


# A forest keeps a number for every row and tree in the memory of its tasks: so many in each.
ENTRIES = 25_000_000


def _spread(rows: DataFrame, model: Estimator) -> DataFrame:
    """``rows``, dealt out evenly to more tasks where one has too many for a forest's trees."""
    most = max(1, ENTRIES // model.getOrDefault("numTrees"))
    sizes = rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.agg(F.sum("n").alias("all"), F.max("n").alias("largest")).first()
    if (found["largest"] or 0) <= most:
        return rows
    return reliable_copy(rows.repartition(-(-found["all"] // most)))


# Fits that go over the table about once: a copy would cost more than it saves.
_ONE_PASS = (LinearRegression, NaiveBayes)


def _used_columns(model: Estimator) -> list[str]:
    """The columns that a fit reads: features, label, and the weight if one is set."""
    named = [model.getOrDefault(p) for p in ("featuresCol", "labelCol")]
    if model.hasParam("weightCol") and model.isDefined("weightCol"):
        named.append(model.getOrDefault("weightCol"))
    return named


def _read_columns(train: DataFrame, stages: Sequence, models: Sequence[Estimator]) -> list[str]:
    """The columns of the table that stages or models name."""
    named = {c for model in models for c in _used_columns(model)}
    for stage in stages:
        for param in ("inputCol", "inputCols", "labelCol"):
            if stage.hasParam(param) and stage.isDefined(param):
                value = stage.getOrDefault(param)
                named |= {value} if isinstance(value, str) else set(value)
    return [c for c in train.columns if c in named]


def fit_several(
    train: DataFrame, stages: Sequence, models: Mapping[str, Estimator], in_memory: bool = False
) -> dict[str, PipelineModel]:
    """Fit feature stages once, and several models on the features.

    What made the table runs once: stages and iterative models read a copy of the
    columns they name.  Models keep the vectors they iterate over by themselves.
    """
    if all(isinstance(model, _ONE_PASS) for model in models.values()):
        features = Pipeline(stages=list(stages)).fit(train)
        return {name: PipelineModel([*features.stages, model.fit(features.transform(train))]) for name, model in models.items()}
    with ready(train.select(*_read_columns(train, stages, list(models.values()))), in_memory) as rows:
        features = Pipeline(stages=list(stages)).fit(rows)
        spread = {n: _spread(rows, model) if model.hasParam("numTrees") else rows for n, model in models.items()}
        fitted = {
            name: model.fit(features.transform(spread[name]).select(*_used_columns(model))) for name, model in models.items()
        }
    return {name: PipelineModel([*features.stages, model]) for name, model in fitted.items()}


def fit(
    train: DataFrame, stages: Sequence, model: Estimator, in_memory: bool = False
) -> PipelineModel:
    """Fit feature stages and a model on a training table; see ``fit_several``."""
    return fit_several(train, stages, {"model": model}, in_memory)["model"]


def perceptron_layers(n_features: int, n_classes: int, hidden: Sequence[int]) -> list[int]:
    """Layer sizes from the length of the feature vector to the number of classes."""
    return [n_features, *hidden, n_classes]


def score(model: Model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Kept columns, ``prediction``, and ``probability`` as an array if there is one."""
    scored = model.transform(df)
    columns = [F.col(c) for c in [*keep, "prediction"]]
    if "probability" in scored.columns:
        columns.append(vector_to_array("probability").alias("probability"))
    return scored.select(*columns)


def blend(models: Mapping[str, tuple[Model, str]], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Average several models' scores of the same rows.

    ``models`` gives, per score column to add, a model and the output it takes:
    ``prediction``, or ``probability`` for the probability of class 1.  The rows
    pass through all models in one plan, so there is no join.
    """
    scored = df
    inputs = list(df.columns)
    for name, (model, output) in models.items():
        after = model.transform(scored)
        value = vector_to_array(output)[1] if output == "probability" else F.col(output)
        scored = after.select(*inputs, value.alias(name))
        inputs.append(name)
    return scored.select(*keep, *models, mean_of(list(models)).alias("score"))


# One model per class ---------------------------------------------------------


def fit_one_vs_rest(train: DataFrame, model: Estimator, parallelism: int = 4) -> OneVsRestModel:
    """Fit one two-class model per class, several at a time."""
    with ready(train) as rows:
        return OneVsRest(classifier=model, parallelism=parallelism).fit(rows)


def score_one_vs_rest(model: OneVsRestModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Score every class and take the best; stays in native expressions.

    ``probability`` holds the class scores rescaled to add up to one.
    """
    inputs = list(df.columns)
    scored = df
    names = []
    for number, part in enumerate(model.models):
        name = f"__score_{number}"
        margin = vector_to_array(part.getRawPredictionCol())[1]
        scored = part.transform(scored).select(*inputs, *names, margin.alias(name))
        names.append(name)
    scores = scored.select(*keep, F.array(*names).alias("scores"))
    return scores.select(
        *keep,
        best_class(F.col("scores")).alias("prediction"),
        softmax(F.col("scores")).alias("probability"),
    )


# Tuning -----------------------------------------------------------------------


def grid(model: Estimator, choices: Mapping[str, Sequence[Any]]) -> list:
    """All combinations of the listed values of the model's parameters."""
    builder = ParamGridBuilder()
    for name, values in choices.items():
        builder = builder.addGrid(model.getParam(name), list(values))
    return builder.build()


def cross_validate(
    train: DataFrame,
    key: str | Sequence[str],
    model: Estimator,
    choices: Mapping[str, Sequence[Any]],
    evaluator: Evaluator | None = None,
    folds: int = 5,
    parallelism: int = 4,
) -> tuple[Model, DataFrame]:
    """Best model over the grid, and one row per combination with its mean measure.

    Folds come from the key, so they do not depend on how rows are partitioned.
    """
    combinations = grid(model, choices)
    with ready(with_fold(train, key, folds)) as rows:
        if evaluator is None and "threshold" in choices:
            best, measures = _validate_thresholds(rows, model, choices, folds, parallelism)
        else:
            validator = CrossValidator(
                estimator=model,
                estimatorParamMaps=combinations,
                evaluator=evaluator or MulticlassClassificationEvaluator(metricName="accuracy"),
                numFolds=folds,
                parallelism=parallelism,
                foldCol="fold",
            )
            fitted = validator.fit(rows)
            best = fitted.bestModel
            measures = [(_described({p.name: v for p, v in c.items()}), float(m))
                        for c, m in zip(combinations, fitted.avgMetrics)]
    table = train.sparkSession.createDataFrame(measures, "params string, measure double")
    return best, table


def _described(values: Mapping[str, Any]) -> str:
    return ", ".join(f"{name}={value}" for name, value in sorted(values.items()))


def _validate_thresholds(
    rows: DataFrame, model: Estimator, choices: Mapping[str, Sequence[Any]], folds: int, parallelism: int
) -> tuple[Model, list[tuple[str, float]]]:
    """Mean accuracy per combination; a threshold changes no fit, so one pass measures them all."""
    others = {name: values for name, values in choices.items() if name != "threshold"}
    fits = [{p.name: v for p, v in c.items()} for c in grid(model, others)]
    label = model.getOrDefault("labelCol")

    def measured(job: tuple[int, int]) -> list[float]:
        number, fold = job
        fitted = fits[number]
        learned = model.copy({model.getParam(n): v for n, v in fitted.items()}).fit(rows.where(F.col("fold") != fold))
        chance = vector_to_array("probability")[1]
        right = [
            F.avg(((chance > t).cast("double") == F.col(label)).cast("double")).alias(str(i))
            for i, t in enumerate(choices["threshold"])
        ]
        return list(learned.transform(rows.where(F.col("fold") == fold)).agg(*right).first())

    jobs = [(number, fold) for number in range(len(fits)) for fold in range(folds)]
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        results = dict(zip(jobs, pool.map(inheritable_thread_target(rows.sparkSession)(measured), jobs)))
    measures, best = [], None
    for number, values in enumerate(fits):
        for i, threshold in enumerate(choices["threshold"]):
            got = [results[number, fold][i] for fold in range(folds)]
            known = [x for x in got if x is not None]  # a fold may be empty
            mean = sum(known) / len(known) if known else 0.0
            full = {**values, "threshold": threshold}
            measures.append((_described(full), mean))
            if best is None or mean > best[0]:
                best = (mean, full)
    return model.copy({model.getParam(n): v for n, v in best[1].items()}).fit(rows), measures


# Looking inside fitted models -----------------------------------------------


def importances(model: Model, names: Sequence[str]) -> DataFrame:
    """(feature, importance) of a fitted tree model; one row per vector slot."""
    values = model.featureImportances.toArray().tolist()
    return _driver_rows(list(zip(names, values)), "feature string, importance double")


def coefficients(model: Model, names: Sequence[str]) -> DataFrame:
    """(term, value) of a fitted linear or two-class logistic model."""
    rows = [("intercept", float(model.intercept))]
    rows += [(n, float(v)) for n, v in zip(names, model.coefficients.toArray())]
    return _driver_rows(rows, "term string, value double")


def training_history(model: Model) -> DataFrame:
    """(iteration, objective) of a fitted iterative model; iteration 0 is the start."""
    history = [(i, float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    return _driver_rows(history, "iteration int, objective double")


def _driver_rows(rows: list[tuple], schema: str) -> DataFrame:
    """Facts a fitted model already holds on the driver: one per slot or iteration."""
    return SparkSession.active().createDataFrame(rows, schema)
