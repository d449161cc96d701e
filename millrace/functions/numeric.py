"""Numeric expressions shared by the classifiers, similarity and regression."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def safe_log(p: Column) -> Column:
    """Natural log with ``log(0) = -infinity`` in place of null."""
    return F.when(p > 0, F.log(p)).otherwise(F.lit(float("-inf")))


def ratio(num: Column, den: Column) -> Column:
    """``num / den``, null where the denominator is zero."""
    return F.when(den != 0, num / den)


def likelier_class(p0: Column, p1: Column) -> Column:
    """Class with the larger probability; ties go to class 0."""
    return F.when(p0 >= p1, F.lit(0)).otherwise(F.lit(1))


def predicted_class(score0: Column, score1: Column) -> Column:
    """Class 1 only when its score is strictly larger."""
    return F.when(score1 > score0, F.lit(1)).otherwise(F.lit(0))


def dot(weights: Mapping[str, float]) -> Column:
    """``bias + sum(weight * column)``; the bias sits under the empty name."""
    total = F.lit(float(weights.get("", 0.0)))
    for name, weight in weights.items():
        if name:
            total = total + F.lit(float(weight)) * F.col(name)
    return total


def jaccard(shared: Column, n1: Column, n2: Column) -> Column:
    return shared / (n1 + n2 - shared)


def dice(shared: Column, n1: Column, n2: Column) -> Column:
    return 2 * shared / (n1 + n2)


def overlap(shared: Column, n1: Column, n2: Column) -> Column:
    return shared / F.least(n1, n2)


def cosine(shared: Column, n1: Column, n2: Column) -> Column:
    return shared / F.sqrt((n1.cast("long") * n2.cast("long")).cast("double"))


def fixed(value: Column | str, digits: int) -> Column:
    """Number as text with a fixed number of digits, for printed reports."""
    return F.format_string(f"%.{digits}f", F.col(value).cast("double") if isinstance(value, str) else value.cast("double"))
