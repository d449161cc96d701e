"""Keyed lookups and the time-window self-join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.text import once
from millrace.operators.skew import Heavy, heavy_keys, salted_join


def role_lookup(df: DataFrame, index: DataFrame, key: str, index_key: str, names: Mapping[str, str]) -> DataFrame:
    """Inner lookup of ``df[key]`` in a table with one row per ``index_key``;
    the index columns arrive under the role names in ``names``.

    Rows whose key is not in the index are dropped. No broadcast hint: Spark
    broadcasts the index by its measured size. Beyond the limit its keys are
    unique, so a heavy key is one index row against many, which the adaptive
    skew join splits.
    """
    side = index.select(F.col(index_key).alias(key), *[F.col(c).alias(n) for c, n in names.items()])
    return df.join(side, key)


def unmatched_keys(df: DataFrame, index: DataFrame, key: str, index_key: str) -> DataFrame:
    """``(key, rows)``: keys that ``role_lookup`` drops, with their rows."""
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("rows"))
    return counts.join(index.select(F.col(index_key).alias("key")).distinct(), "key", "left_anti")


def hourly_lookup(
    df: DataFrame,
    readings: DataFrame,
    keys: Mapping[str, str],
    names: Mapping[str, str],
    spread: Sequence[str],
    heavy: Heavy | None = None,
    heavy_right: Heavy | None = None,
) -> DataFrame:
    """Left lookup on (place, date, hour): ``keys`` maps columns of ``df`` to
    those of ``readings``. Several readings of an hour give several rows; a
    row without reading stays, with nulls. Heavy hours are split on the side,
    or sides, that hold many rows."""
    side = readings.select(*[F.col(r).alias(k) for k, r in keys.items()], *[F.col(c).alias(n) for c, n in names.items()])
    heavy_right = heavy_keys(side, list(keys))[0] if heavy_right is None else heavy_right
    return salted_join(df, side, list(keys), spread, how="left", heavy=heavy, heavy_right=heavy_right)


def window_bucket(at: Column, lower: int, upper: int) -> Column:
    """The bucket of a left row on the time axis."""
    return F.floor(at / (upper - lower))


def window_self_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    at: str,
    earlier: str,
    lower: int,
    upper: int,
    spread: Sequence[str],
    heavy: Heavy | None = None,
    heavy_right: Heavy | None = None,
) -> DataFrame:
    """Left join: ``right`` rows of the same keys with
    ``left.at - upper < right.earlier < left.at - lower`` (both strict).

    The time axis is cut into buckets as wide as the window. A left row lies
    in one bucket; a right row is copied to the two buckets its partners can
    lie in. So each pair meets once, only rows near in time meet at all, and
    unmatched left rows stay. Both sides are of the size of the data: they are
    merged on their shuffled keys and never broadcast.

    ``heavy`` and ``heavy_right`` are the heavy values of the keys with the
    bucket, on the left and among the copies of the right. With heavy right
    keys the pairs meet on a grid of parts; whether a left row has a partner
    depends on its key and time only, so the rows without one are found from
    the different times of both sides.
    """
    width = upper - lower
    if width <= 0:
        raise ValueError("upper must exceed lower")
    first = F.floor((F.col(earlier) + lower) / width)
    last = F.floor((F.col(earlier) + upper) / width)
    # the time is computed once, and not again for each bound and each bucket
    near = right.withColumn(earlier, once(F.col(earlier))).withColumn("_bucket", F.explode(F.sequence(first, last))).hint("merge")
    placed = left.withColumn("_bucket", window_bucket(F.col(at), lower, upper))
    inside = (F.col(f"r.{earlier}") > F.col(f"l.{at}") - upper) & (F.col(f"r.{earlier}") < F.col(f"l.{at}") - lower)
    on = [*keys, "_bucket"]
    if not heavy_right:
        return salted_join(placed, near, on, spread, how="left", heavy=heavy, residual=inside).drop("_bucket")
    pairs = salted_join(placed, near, on, spread, "inner", heavy, inside, heavy_right).drop("_bucket")
    times, ticks = left.select(*keys, at).distinct(), right.select(*keys, earlier).distinct()
    met = window_self_join(times, ticks, keys, at, earlier, lower, upper, [at], heavy={}).where(F.col(earlier).isNotNull())
    alone = left.join(met.select(*keys, at).distinct(), [*keys, at], "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True).select(pairs.columns)


def window_self_summary(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    at: str,
    earlier: str,
    lower: int,
    upper: int,
    value: str,
    spread: Sequence[str],
    heavy: Heavy | None = None,
) -> DataFrame:
    """One row per ``left`` row: ``matches``, ``mean_<value>`` and
    ``max_<value>`` over the rows ``window_self_join`` would pair it with.

    ``at`` and ``earlier`` are whole numbers on a clock. Both sides are first
    reduced to one row per key and clock position, so a key's work is bounded
    by the clock and not by its number of rows; no pair of rows is formed.
    ``heavy`` are the heavy values of the keys with ``at``.
    """
    ticks = right.where(F.col(earlier).isNotNull()).groupBy(*keys, earlier).agg(
        F.count("*").alias("_n"), F.count(value).alias("_v"), F.sum(value).alias("_sum"), F.max(value).alias("_max")
    )
    moments = left.groupBy(*keys, at).agg(F.count("*").alias("_rows")).drop("_rows")
    inside = window_self_join(moments, ticks, keys, at, earlier, lower, upper, [at], heavy={})
    stats = (
        inside.where(F.col("_n").isNotNull())
        .groupBy(*keys, at)
        .agg(
            F.sum("_n").alias("matches"),
            F.try_divide(F.sum("_sum"), F.sum("_v")).alias(f"mean_{value}"),
            F.max("_max").alias(f"max_{value}"),
        )
    )
    return salted_join(left, stats, [*keys, at], spread, how="left", heavy=heavy).withColumn("matches", F.coalesce("matches", F.lit(0)))


def attach_group_index(df: DataFrame, index: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of rows with their group's statistics, one row per group."""
    return df.join(index, list(keys))
