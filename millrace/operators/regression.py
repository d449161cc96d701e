"""Linear models by gradient descent from one pass of aggregated sums.

Gradient and loss depend on the data only through ``n``, ``X'X``, ``X'y`` and
``y'y``. Spark sums those products once, per fold where folds are asked for;
the steps then work on a matrix of the size of the feature list.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import numeric
from millrace.operators.profile import box_stats

BIAS = "bias"


@dataclass(frozen=True)
class Moments:
    """Sums of products of the bias, the features and the label."""

    n: float
    xx: np.ndarray
    xy: np.ndarray
    yy: float

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.xx + other.xx, self.xy + other.xy, self.yy + other.yy)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.xx - other.xx, self.xy - other.xy, self.yy - other.yy)

    def loss(self, w: np.ndarray) -> float:
        """Mean squared error of the weights."""
        return float((w @ self.xx @ w - 2 * (w @ self.xy) + self.yy) / self.n)

    def gradient(self, w: np.ndarray, scale: float = 2.0) -> np.ndarray:
        return scale * (self.xx @ w - self.xy) / self.n


def feature_stats(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per feature."""
    row = df.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(features) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(features)}


def standardise(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """Centre and scale by given statistics, those of the training rows also
    for held-out rows. A constant feature becomes 0."""
    return df.withColumns(
        {c: ((F.col(c) - m) / s if s else F.lit(0.0)) for c, (m, s) in stats.items()}
    )


def label_stats(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.avg(label).alias("mean"), F.var_pop(label).alias("variance"))


def moments(df: DataFrame, features: Sequence[str], label: str, by: str | None = None) -> dict:
    """``Moments`` per value of ``by`` (key None without it): one aggregate of
    (p+1)(p+2)/2 + p + 2 sums, merged map-side."""
    terms: list[Column] = [F.lit(1.0), *[F.col(c).cast("double") for c in features]]
    y = F.col(label).cast("double")
    p = len(terms)
    sums = [F.sum(terms[i] * terms[j]).alias(f"x{i}_{j}") for i in range(p) for j in range(i, p)]
    sums += [F.sum(terms[i] * y).alias(f"y{i}") for i in range(p)] + [F.sum(y * y).alias("yy")]
    grouped = df.groupBy(by) if by else df
    out = {}
    for row in grouped.agg(*sums).collect():
        xx = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                xx[i, j] = xx[j, i] = row[f"x{i}_{j}"]
        out[row[by] if by else None] = Moments(float(xx[0, 0]), xx, np.array([row[f"y{i}"] for i in range(p)]), float(row["yy"]))
    return out


def baseline(m: Moments) -> np.ndarray:
    """Mean label as bias, zero weights."""
    w = np.zeros(len(m.xy))
    w[0] = m.xy[0] / m.n
    return w


def penalty(w: np.ndarray, kind: str | None, strength: float) -> float:
    if kind == "ridge":
        return float(strength * np.sum(w[1:] ** 2))
    if kind == "lasso":
        return float(strength * np.sum(np.abs(w[1:])))
    return 0.0


def step(m: Moments, w: np.ndarray, rate: float = 0.1, kind: str | None = None, strength: float = 0.1, scale: float = 2.0) -> np.ndarray:
    """One gradient step; the bias carries no penalty."""
    grad = m.gradient(w, scale)
    free = np.concatenate([[0.0], w[1:]])
    if kind == "ridge":
        grad = grad + 2 * strength * free
    elif kind == "lasso":
        grad = grad + strength * np.sign(free)
    elif kind is not None:
        raise ValueError(f"unknown penalty {kind!r}")
    return w - rate * grad


def descend(
    train: Moments, test: Moments | None, w: np.ndarray, steps: int, rate: float = 0.1, kind: str | None = None, strength: float = 0.1
) -> list[tuple[int, np.ndarray, float, float | None]]:
    """``(step, weights, train loss, test loss)``; losses include the penalty."""
    history = []
    for k in range(1, steps + 1):
        w = step(train, w, rate, kind, strength)
        extra = penalty(w, kind, strength)
        history.append((k, w, train.loss(w) + extra, None if test is None else test.loss(w) + extra))
    return history


def descend_folds(folds: dict, w: np.ndarray, steps: int, rate: float = 0.1, scale: float = 2.0) -> list[tuple[int, float, float]]:
    """k-fold descent: ``(step, train loss, test loss)``, each the mean over
    folds. The model of fold k trains on everything but fold k. ``scale=1``
    leaves the factor 2 out of the gradient."""
    whole = None
    for m in folds.values():
        whole = m if whole is None else whole + m
    models = {k: w for k in folds}

    def losses(at: int) -> tuple[int, float, float]:
        return (
            at,
            float(np.mean([(whole - folds[k]).loss(models[k]) for k in folds])),
            float(np.mean([folds[k].loss(models[k]) for k in folds])),
        )

    out = [losses(0)]
    for k in range(1, steps + 1):
        models = {f: step(whole - folds[f], models[f], rate, scale=scale) for f in folds}
        out.append(losses(k))
    return out


def model_table(spark, history, features: Sequence[str], model: str) -> DataFrame:
    """Coefficient paths: ``(model, step, term, weight)``."""
    names = [BIAS, *features]
    rows = [(model, k, t, float(v)) for k, w, *_ in history for t, v in zip(names, w)]
    return spark.createDataFrame(rows, "model string, step int, term string, weight double")


def loss_table(spark, history, model: str) -> DataFrame:
    """``(model, step, train_loss, test_loss)``."""
    rows = [(model, k, tr, te) for k, _, tr, te in history]
    return spark.createDataFrame(rows, "model string, step int, train_loss double, test_loss double")


def weights_of(w: np.ndarray, features: Sequence[str]) -> dict[str, float]:
    return {"": float(w[0]), **{c: float(v) for c, v in zip(features, w[1:])}}


def mean_squared_error(df: DataFrame, weights: dict[str, float], label: str) -> DataFrame:
    """MSE by a pass over the data; the check on the aggregated form."""
    return df.agg(F.avg(F.pow(numeric.dot(weights) - F.col(label), 2)).alias("mse"))


def data_pass_step(df: DataFrame, weights: dict[str, float], label: str, rate: float = 0.1) -> dict[str, float]:
    """One plain gradient step by a pass over the data, for feature lists too
    wide for a matrix of products."""
    names = [c for c in weights if c]
    err = F.col(label) - numeric.dot(weights)
    row = df.agg(F.avg(err).alias("_b"), *[F.avg(err * F.col(c)).alias(f"_{i}") for i, c in enumerate(names)]).first()
    out = {"": weights.get("", 0.0) + 2 * rate * row["_b"]}
    out.update({c: weights[c] + 2 * rate * row[f"_{i}"] for i, c in enumerate(names)})
    return out


def residuals(df: DataFrame, weights: dict[str, float], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Label minus prediction, with the label."""
    return df.select(*keep, F.col(label), (F.col(label) - numeric.dot(weights)).alias("residual"))


def residual_box(df: DataFrame, weights: dict[str, float], label: str, by: str | None = None) -> DataFrame:
    """Residual quartiles per label value, or per value of a column ``by``,
    such as a bucket of a continuous label."""
    by = by or label
    return box_stats(residuals(df, weights, label, [by] if by != label else []), by, "residual")
