"""Samples, splits and folds.

The ``hash_*`` forms decide by the row's key and can be recomputed anywhere;
the plain forms are Spark's own samplers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.hashing import key_fraction, key_hash
from millrace.operators.skew import global_rank


def bernoulli(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(False, fraction, seed)


def with_replacement(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(True, fraction, seed)


def poisson_copies(df: DataFrame, keys: list[str], rate: float, seed: int = 42) -> DataFrame:
    """Sample with replacement that a retry repeats: each row comes as often
    as a Poisson number of mean ``rate`` says, drawn by the inverse of its
    distribution function from the hash of the row's key."""
    number = F.lit(0)
    for bound in poisson_bounds(rate):
        number = number + (key_fraction(*keys, seed=seed) >= bound).cast("int")
    copies = df.withColumn("_copies", number).where(F.col("_copies") > 0)
    return copies.withColumn("_copies", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies")


def poisson_bounds(rate: float) -> list[float]:
    """Probabilities of at most 0, 1, 2, … events, up to where no 32-bit
    fraction lies beyond."""
    term = total = math.exp(-rate)
    out = []
    while total <= 1 - 2.0**-32:
        out.append(total)
        term *= rate / len(out)
        total += term
    return out


def hash_sample(df: DataFrame, keys: list[str], fraction: float, seed: int = 42) -> DataFrame:
    return df.where(key_fraction(*keys, seed=seed) < fraction)


def fixed_size(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in the order of their key hash; each task keeps ``n`` rows."""
    return df.orderBy(key_hash(*keys, seed=seed), *keys).limit(n)


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    return df.randomSplit(weights, seed)


def hash_split(df: DataFrame, keys: list[str], train_fraction: float = 0.8, seed: int = 42) -> DataFrame:
    """Adds ``is_train``; both parts come from one pass over the data."""
    return df.withColumn("is_train", key_fraction(*keys, seed=seed) < train_fraction)


def assign_folds(df: DataFrame, keys: list[str], k: int, seed: int = 42) -> DataFrame:
    """Adds ``fold`` in ``0..k-1``."""
    return df.withColumn("fold", F.pmod(key_hash(*keys, seed=seed), F.lit(k)).cast("int"))


def positional_split(df: DataFrame, key: str, first: int | None = None, fraction: float | None = None) -> DataFrame:
    """Adds ``is_train``: the first ``first`` rows, or the first ``fraction``
    of the rows, in the order of a unique numeric key."""
    ranked = global_rank(df, key, "_rank")
    if first is not None:
        return ranked.withColumn("is_train", F.col("_rank") <= first).drop("_rank")
    total = df.agg(F.count("*").alias("n"))
    return ranked.withColumn("is_train", F.col("_rank") <= F.floor(total.scalar() * fraction)).drop("_rank")


def time_split(df: DataFrame, year: Column, test_from: int) -> DataFrame:
    """Adds ``is_train``: rows before year ``test_from`` train, later rows test."""
    return df.withColumn("is_train", year < test_from)
