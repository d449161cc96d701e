"""Table profiling, outcome rates, group indexes and distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import numeric
from millrace.operators.skew import running
from millrace.session import stored


def _long(row: DataFrame, names: Sequence[str], value: str, key: str = "column") -> DataFrame:
    """Turn one aggregate row ``_0, _1, …`` into ``(key, value)`` rows."""
    pairs = F.array(*[F.struct(F.lit(n).alias("k"), F.col(f"_{i}").alias("v")) for i, n in enumerate(names)])
    return row.select(F.explode(pairs).alias("_p")).select(F.col("_p.k").alias(key), F.col("_p.v").alias(value))


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """``(column, distinct_values)`` for every column, in one job.

    Exact by default: values are cast to text, unpivoted and made distinct
    per task before the shuffle, whose key is (column, value), so a column
    with few values costs almost nothing. ``approx`` keeps one sketch per column.
    """
    cols = list(cols or df.columns)
    if approx:
        row = df.agg(*[F.approx_count_distinct(c, rsd).alias(f"_{i}") for i, c in enumerate(cols)])
        return _long(row, cols, "distinct_values")
    cells = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("_p")
    ).select("_p.column", "_p.value")
    seen = cells.distinct()
    return seen.groupBy("column").agg(F.count("value").alias("distinct_values"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, nulls)`` from one aggregate."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(cols)])
    return _long(row, cols, "nulls")


def blank_fractions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, blank_fraction)``: share of null, empty or all-space cells."""
    empty = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    row = df.agg(*[F.avg(empty(c).cast("double")).alias(f"_{i}") for i, c in enumerate(cols)])
    return _long(row, list(cols), "blank_fraction")


def complete_columns(df: DataFrame, cols: Sequence[str], at_least: float = 0.8) -> DataFrame:
    """Columns whose filled share reaches ``at_least``: ``(column, filled)``."""
    return blank_fractions(df, cols).select("column", (1 - F.col("blank_fraction")).alias("filled")).where(F.col("filled") >= at_least)


def outcome_odds(df: DataFrame, outcome: Column) -> DataFrame:
    """One row: rows with and without the outcome, its rate and its odds."""
    return df.agg(
        F.count_if(outcome).alias("with_outcome"), F.count_if(~outcome).alias("without_outcome")
    ).select(
        "with_outcome",
        "without_outcome",
        numeric.ratio(F.col("with_outcome"), F.col("with_outcome") + F.col("without_outcome")).alias("rate"),
        numeric.ratio(F.col("with_outcome"), F.col("without_outcome")).alias("odds"),
    )


def outcome_rates(df: DataFrame, outcome: Column, dims: Mapping[str, Column]) -> DataFrame:
    """``(dimension, value, rate, n)`` for several dimensions in one pass.

    A row becomes one cell per dimension, summed map-side: what is shuffled
    are the values of each dimension, never their combinations.
    """
    cells = F.array(*[F.struct(F.lit(n).alias("dimension"), c.cast("string").alias("value")) for n, c in dims.items()])
    counted = (
        df.select(outcome.cast("int").alias("_y"), F.explode(cells).alias("_c"))
        .groupBy("_c.dimension", "_c.value")
        .agg(F.sum("_y").alias("_hits"), F.count("_y").alias("n"))
    )
    return counted.select("dimension", "value", numeric.ratio(F.col("_hits"), F.col("n")).alias("rate"), "n")


def group_means(df: DataFrame, keys: Sequence[str], measures: Sequence[str], prefix: str = "MEAN_") -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(m).alias(prefix + m) for m in measures])


def group_medians(df: DataFrame, keys: Sequence[str], measures: Sequence[str], prefix: str = "MEDIAN_", accuracy: int = 10_000) -> DataFrame:
    """Approximate medians: their rank is off by at most ``n / accuracy``. The
    sketches merge map-side, so a large group does not gather its rows in one
    place."""
    return df.groupBy(*keys).agg(*[F.percentile_approx(m, 0.5, accuracy).alias(prefix + m) for m in measures])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))


def histogram(df: DataFrame, col: str, bins: int, upper: float | None = None) -> DataFrame:
    """``(bin, low, high, n)`` over equal-width bins from min to max.

    With ``upper`` larger values are left out, as for a plot with its tail
    cut. The last bin includes its upper edge; empty bins are not listed.
    """
    data = df.select(F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    if upper is not None:
        data = data.where(F.col("_v") <= upper)
    ends = data.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi")).alias("e"))
    lo, hi = F.col("_e.lo"), F.col("_e.hi")
    width = (hi - lo) / bins
    place = F.when(width > 0, F.least(F.floor((F.col("_v") - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    return (
        data.withColumn("_e", ends.scalar())
        .select((place + 1).alias("bin"), "_e")
        .groupBy("bin", "_e")
        .agg(F.count("*").alias("n"))
        .select("bin", (lo + (F.col("bin") - 1) * width).alias("low"), (lo + F.col("bin") * width).alias("high"), "n")
    )


_QUARTILES = (0.25, 0.5, 0.75)


def exact_quantiles(df: DataFrame, by: str, value: str, probs: Sequence[float] = _QUARTILES, accuracy: int = 1000) -> DataFrame:
    """``(by, which, quantile)``: per group the smallest value that at least
    ``ceil(p * n)`` rows do not exceed; ``which`` is the place in ``probs``.

    Exact at any size, in two passes. A mergeable sketch per group, whose rank
    error is below ``n / accuracy``, gives a bracket around every wanted rank.
    Then rows inside a bracket are counted by value, rows between brackets in
    one sum, both map-side; so a few thousandths of the rows at most are
    moved, fewer if values repeat. The counts of all groups are summed up in
    order over range partitions, so neither a group nor a value gathers rows
    in one task.
    """
    order = sorted(range(len(probs)), key=lambda i: probs[i])
    rows = df.select(F.col(by).alias("by"), F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    edges = [e for i in order for e in (max(0.0, probs[i] - 3 / accuracy), min(1.0, probs[i] + 3 / accuracy))]
    found = rows.groupBy("by").agg(
        F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"), F.percentile_approx("v", F.array(*[F.lit(e) for e in edges]), accuracy).alias("e")
    )
    # a rank is a whole number, so the brackets of a small group are all of it
    small = F.col("n") <= 10 * accuracy
    ends = [F.when(small, F.col("most" if j % 2 else "least")).otherwise(F.get("e", F.lit(j))).alias(f"e{j}") for j in range(len(edges))]
    brackets = stored(found.select("by", "n", *ends))

    # the point that stands for a row in the counts: its value, or the next bracket's begin
    point = exact = None
    for k in range(len(order)):
        low, high = F.col(f"e{2 * k}"), F.col(f"e{2 * k + 1}")
        before, inside = F.col("v") < low, F.col("v") <= high
        point = F.when(before, low).when(inside, F.col("v")) if point is None else point.when(before, low).when(inside, F.col("v"))
        exact = F.when(before, False).when(inside, True) if exact is None else exact.when(before, False).when(inside, True)
    met = rows.alias("x").join(brackets.alias("b"), F.col("x.by").eqNullSafe(F.col("b.by")))
    counts = met.select("x.by", point.alias("point"), exact.alias("exact")).where("exact IS NOT NULL").groupBy("by", "point", "exact").agg(F.count("*").alias("n"))
    upto = running(counts, ["by", "point", "exact"], {"upto": "n"}, within=["by"])
    ranks = F.array(*[F.struct(F.lit(i).alias("which"), F.greatest(F.ceil(F.col("n") * p), F.lit(1)).alias("rank")) for i, p in enumerate(probs)])
    wanted = brackets.select("by", F.inline(ranks))
    reached = F.col("rank").between(F.col("upto") - F.col("n") + 1, F.col("upto"))
    hit = upto.where("exact").alias("u").join(wanted.alias("w"), F.col("u.by").eqNullSafe(F.col("w.by")) & reached)
    return hit.select("u.by", "which", F.col("point").alias("quantile"))


def _quartile_columns(df: DataFrame, by: str, value: str) -> DataFrame:
    found = exact_quantiles(df, by, value)
    return found.groupBy("by").agg(*[F.max(F.when(F.col("which") == i, F.col("quantile"))).alias(name) for i, name in enumerate(("q1", "median", "q3"))])


def box_stats(df: DataFrame, by: str, measure: str) -> DataFrame:
    """Minimum, exact quartiles, maximum and count of a measure per class."""
    ends = df.groupBy(by).agg(F.min(measure).alias("low"), F.max(measure).alias("high"), F.count(measure).alias("n"))
    quartiles = _quartile_columns(df, by, measure)
    joined = ends.join(quartiles, F.col(by).eqNullSafe(F.col("by")), "left")
    kind = ends.schema["low"].dataType
    return joined.select(by, "low", *[F.col(q).cast(kind).alias(q) for q in ("q1", "median", "q3")], "high", "n")


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(a, b, r)``: Pearson correlation of every column pair, one aggregate."""
    pairs = list(combinations(cols, 2))
    row = df.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("r")) for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(cells).alias("_p")).select("_p.a", "_p.b", "_p.r")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, n, mean, stddev, low, q1, median, q3, high)``, quartiles
    exact. Columns become rows, summed map-side."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])
    long = df.select(F.inline(cells))
    stats = long.groupBy("column").agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("stddev"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    joined = stats.join(_quartile_columns(long, "column", "v"), F.col("column") == F.col("by"), "left")
    return joined.select("column", "n", "mean", "stddev", "low", "q1", "median", "q3", "high")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))
