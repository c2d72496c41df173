"""Cross validation that keeps what it measured, and measures its winner.

Every combination of parameters is fitted once per fold; the measures of single
folds stay beside their mean.  The winner is fitted on the whole table, and the
models of its folds are kept, so that every row can also be scored by the model
that has not seen it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.split import with_fold
from tallymark.session import reliable_copy

Measure = Callable[[Column, Column], Column]


def accuracy(label: Column, prediction: Column) -> Column:
    """Share of rows whose prediction is the label."""
    return F.avg((label == prediction).cast("double"))


def root_mean_square(label: Column, prediction: Column) -> Column:
    """Minus the root of the mean squared error: larger is better here, too."""
    return -F.sqrt(F.avg((label - prediction) * (label - prediction)))


@dataclass(frozen=True)
class Validated:
    """What a cross validation found."""

    best: Mapping[str, Any]
    model: Model  # the winner, fitted on all rows
    fold_models: Mapping[int, Model]  # the winner's: number k has not seen fold k
    rows: DataFrame  # the training table with its folds
    folds: DataFrame  # params, fold, n, measure
    grid: DataFrame  # params, measure (mean of the folds), best
    label: str
    measure: Measure


def combinations(choices: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """All combinations, the first parameter varying slowest."""
    return [dict(zip(choices, values)) for values in product(*choices.values())]


def described(values: Mapping[str, Any]) -> str:
    return ", ".join(f"{name}={value}" for name, value in sorted(values.items()))


def with_params(model: Estimator, values: Mapping[str, Any]) -> Estimator:
    return model.copy({model.getParam(name): value for name, value in values.items()})


def _predicted(model: Model, rows: DataFrame, threshold: float | None) -> tuple[DataFrame, Column]:
    scored = model.transform(rows)
    if threshold is None:
        return scored, F.col("prediction")
    return scored, (vector_to_array("probability")[1] > threshold).cast("double")


def validate(
    train: DataFrame,
    key: str | Sequence[str],
    model: Estimator,
    choices: Mapping[str, Sequence[Any]],
    measure: Measure = accuracy,
    folds: int = 5,
    parallelism: int = 5,
) -> Validated:
    """Fit every combination of ``choices`` on all folds but one, in turn.

    Folds follow from a digest of ``key``.  A threshold of a two-class model costs
    no fit: all thresholds are measured in one pass over a fold.  Of equal
    combinations the first wins.  The folds of one combination are fitted side by
    side; only the winner's models are kept, so the driver never holds more than
    two combinations.  Folds without rows, and a fold that holds all rows, are left out.
    """
    rows = reliable_copy(with_fold(train, key, folds))
    label = model.getOrDefault("labelCol")
    sizes = {r["fold"]: r["n"] for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    used = sorted(fold for fold, n in sizes.items() if n < sum(sizes.values()))
    if not used:
        raise ValueError("cross validation needs rows in two folds at least")
    thresholds = list(choices.get("threshold", [None]))
    fits = combinations({name: values for name, values in choices.items() if name != "threshold"})

    def measured(values: Mapping[str, Any], fold: int) -> tuple[Model, list[float]]:
        learned = with_params(model, values).fit(rows.where(F.col("fold") != fold))
        apart = rows.where(F.col("fold") == fold)
        scored = learned.transform(apart)
        found = [measure(F.col(label), _predicted(learned, apart, t)[1]).alias(f"m{i}") for i, t in enumerate(thresholds)]
        return learned, list(scored.agg(*found).first())

    of_folds: list[tuple] = []
    means: list[tuple[dict, float]] = []
    winner: tuple[float, dict, dict[int, Model]] | None = None
    with ThreadPool(min(parallelism, len(used))) as pool:
        for values in fits:
            job = inheritable_thread_target(rows.sparkSession)(lambda fold, values=values: measured(values, fold))
            results = dict(zip(used, pool.map(job, used)))
            for i, threshold in enumerate(thresholds):
                full = values if threshold is None else {**values, "threshold": threshold}
                got = [results[fold][1][i] for fold in used]
                of_folds += [(described(full), fold, sizes[fold], float(m)) for fold, m in zip(used, got)]
                mean = sum(got) / len(got)
                means.append((full, mean))
                if winner is None or mean > winner[0]:
                    winner = mean, full, {fold: results[fold][0] for fold in used}
    best = winner[1]
    spark = rows.sparkSession
    first = means.index((best, winner[0]))
    table = [(described(full), float(m), i == first) for i, (full, m) in enumerate(means)]
    return Validated(
        best, with_params(model, best).fit(rows), winner[2], rows,
        spark.createDataFrame(of_folds, "params string, fold int, n long, measure double"),
        spark.createDataFrame(table, "params string, measure double, best boolean"),
        label, measure,
    )


def held_out(found: Validated, keep: Sequence[str]) -> DataFrame:
    """Kept columns, ``fold``, and the ``prediction`` of the winner's model that has not seen the row."""
    threshold = found.best.get("threshold")
    parts = []
    for fold, model in found.fold_models.items():
        scored, prediction = _predicted(model, found.rows.where(F.col("fold") == fold), threshold)
        parts.append(scored.select(*keep, "fold", prediction.alias("prediction")))
    return reduce(DataFrame.unionAll, parts)


def report(found: Validated, test: DataFrame) -> DataFrame:
    """(part, n, measure): the winner on the rows it was fitted on and on others, in one pass."""
    columns = [c for c in found.rows.columns if c != "fold"]
    both = found.rows.select(*columns, F.lit("train").alias("part")).unionAll(
        test.select(*columns, F.lit("test").alias("part"))
    )
    scored, prediction = _predicted(found.model, both, found.best.get("threshold"))
    return scored.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), found.measure(F.col(found.label), prediction).alias("measure")
    )
