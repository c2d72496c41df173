"""Expressions for labels, codes and class scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def binary_label(name: str, positive: str) -> Column:
    """1 where the trimmed text equals ``positive``, else 0 (NULL counts as 0)."""
    return F.when(F.trim(F.col(name)) == positive, 1).otherwise(0)


def membership_code(in_first: Column, in_second: Column, one_sided: int = 3) -> Column:
    """1 for both lists, 2 for neither, ``one_sided`` for exactly one of them.

    ``one_sided=2`` gives the stricter reading in which a row counts only when
    it is on both lists.
    """
    return (
        F.when(in_first & in_second, 1).when(in_first | in_second, one_sided).otherwise(2)
    )


def row_total(names: Sequence[str], missing_as_zero: bool = True) -> Column:
    """Sum of several columns of one row."""
    terms = [F.coalesce(F.col(n), F.lit(0)) if missing_as_zero else F.col(n) for n in names]
    return reduce(lambda left, right: left + right, terms)


def mean_of(names: Sequence[str]) -> Column:
    """Plain average of several score columns of one row."""
    return row_total(names, missing_as_zero=False) / F.lit(float(len(names)))


def best_class(scores: Column) -> Column:
    """Position of the largest score, counted from 0; the first one wins ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("double")


def softmax(scores: Column) -> Column:
    """Scores rescaled to positive numbers that add up to one."""
    top = F.array_max(scores)
    powers = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(powers, F.lit(0.0), lambda acc, p: acc + p)
    return F.transform(powers, lambda p: p / total)


def above(probability: Column, threshold: float) -> Column:
    """1.0 where the probability exceeds the cut-off, else 0.0."""
    return (probability > threshold).cast("double")


# Thresholds of classes ----------------------------------------------------------


def class_by_thresholds(probabilities: Column, thresholds: Sequence[float]) -> Column:
    """The class whose probability is largest against its threshold, as a double.

    A class with threshold 0 wins wherever it has any probability at all.  Of equal
    quotients the first class wins.  NULL where there are no probabilities; a row
    with another number of them fails the job.
    """
    checked_thresholds(thresholds)
    quotients = F.zip_with(
        probabilities,
        F.array(*[F.lit(float(t)) for t in thresholds]),
        lambda p, t: F.when(t > 0, p / F.when(t > 0, t)).when(p > 0, F.lit(float("inf"))).otherwise(F.lit(-1.0)),
    )
    sized = F.when(F.size(probabilities) == len(thresholds), best_class(quotients)).otherwise(
        F.raise_error(F.lit(f"a row needs {len(thresholds)} probabilities")).cast("double")
    )
    return F.when(probabilities.isNotNull(), sized)


def checked_thresholds(thresholds: Sequence[float]) -> list[float]:
    """The thresholds, if they may be used: none negative, at most one 0, some positive."""
    found = [float(t) for t in thresholds]
    if not found or min(found) < 0 or found.count(0.0) > 1 or sum(found) <= 0:
        raise ValueError("thresholds must not be negative, at most one may be 0, and one must be positive")
    return found


def threshold_of(thresholds: Sequence[float]) -> float:
    """The one threshold for class 1 that decides as a pair of thresholds does."""
    against, for_ = checked_thresholds(thresholds)
    return 1.0 / (1.0 + against / for_) if for_ else 0.0


def thresholds_of(threshold: float) -> list[float]:
    """The pair of thresholds that decides as one threshold for class 1 does."""
    return [1.0 - threshold, float(threshold)]


def agreeing_threshold(
    threshold: float | None, thresholds: Sequence[float] | None, tolerance: float = 1e-5
) -> float | None:
    """The threshold that either form states; forms that do not agree are refused."""
    if thresholds is None:
        return threshold
    if len(thresholds) != 2:
        if threshold is not None:
            raise ValueError("one threshold is for two classes only")
        return None
    stated = threshold_of(thresholds)
    if threshold is not None and abs(threshold - stated) >= tolerance:
        raise ValueError(f"threshold {threshold} and thresholds {list(thresholds)}, which state {stated}, do not agree")
    return stated
