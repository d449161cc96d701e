"""Cleaning and clock expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F


def composite_field(col: str, index: int, dtype: str = "double", sep: str = ",") -> Column:
    """Field ``index`` of a delimited string; null when absent or not a number."""
    return F.get(F.split(F.col(col), sep), F.lit(index)).try_cast(dtype)


def sentinel(value: Column, missing: float, default: float) -> Column:
    """Replace the missing-value code of a sensor reading by its default."""
    return F.when(value == missing, F.lit(float(default))).otherwise(value)


def clean_composites(df: DataFrame, spec: Iterable[tuple]) -> DataFrame:
    """Add cleaned numeric columns from ``(target, source, index, missing, default)``.

    ``missing`` may be None for a field without replacement.
    """
    added = {}
    for target, source, index, missing, default in spec:
        field = composite_field(source, index)
        added[target] = field if missing is None else sentinel(field, missing, default)
    return df.withColumns(added)


def nulls_to_zero(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.fillna(0, subset=list(cols))


def blank_to_null(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.when(F.trim(col) != "", col)


def clock_hour(hhmm: Column | str, mode: str = "clock") -> Column:
    """Hour of an HHMM integer.

    ``clock`` cuts the minutes off. ``half_even`` rounds at fifty minutes to
    the even hundred, which can yield hour 24.
    """
    hhmm = F.col(hhmm) if isinstance(hhmm, str) else hhmm
    if mode == "clock":
        return F.floor(hhmm / 100).cast("int")
    if mode == "half_even":
        return (F.bround(hhmm, -2) / 100).cast("int")
    raise ValueError(f"unknown clock mode {mode!r}")


def clock_minutes(hhmm: Column | str) -> Column:
    """Minutes since midnight of an HHMM integer."""
    hhmm = F.col(hhmm) if isinstance(hhmm, str) else hhmm
    return (F.floor(hhmm / 100) * 60 + F.pmod(hhmm, F.lit(100))).cast("int")


def date_part(ts: Column | str) -> Column:
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts)


def hour_part(ts: Column | str) -> Column:
    return F.hour(F.col(ts) if isinstance(ts, str) else ts)


def prefixed(df: DataFrame, prefix: str, keep: Iterable[str] = (), rename: Mapping[str, str] | None = None) -> DataFrame:
    """Role-rename every column before a self or lookup join."""
    rename = rename or {}
    kept = set(keep)
    return df.select(
        [F.col(c).alias(c if c in kept else rename.get(c, prefix + c)) for c in dict.fromkeys(df.columns)]
    )


def unique_columns(cols: Iterable[str]) -> list[str]:
    """A column list without repeats, order kept."""
    return list(dict.fromkeys(cols))
