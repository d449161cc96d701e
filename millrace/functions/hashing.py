"""Deterministic pseudo-random numbers taken from a row's own key.

A row gets the same number on every attempt, on every executor and in any
partitioning, so samples and folds survive retries and can be recomputed.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_RANGE = 1 << 32


def key_hash(*keys: Column | str, seed: int = 42) -> Column:
    """32-bit number from the md5 of the seed and the key columns."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def key_fraction(*keys: Column | str, seed: int = 42) -> Column:
    """Number in [0, 1) from the key."""
    return key_hash(*keys, seed=seed) / F.lit(float(_RANGE))
