"""Sinks. Results are written by the executors, never through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


_BREAKS = "\t\n\r\0"


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """Tab-separated records without quoting. The format cannot hold tabs and
    line breaks inside a value, so they become blanks; null is empty. Files of
    a ``compression`` carry its suffix, by which the scans know it."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    flat = df.select(*[(F.translate(F.col(f"`{c}`"), _BREAKS, " " * len(_BREAKS)) if c in text else F.col(f"`{c}`")).alias(c) for c in df.columns])
    options = {"sep": "\t", "quote": "", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "compression": compression}
    flat.write.mode(mode).options(**options).csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "overwrite") -> None:
    """Records with a header line in every file; quoted where a value needs it.
    An empty string is quoted, so that it is told from null."""
    options = {"sep": sep, "header": header, "escape": '"', "emptyValue": '""', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(**options).csv(path)


def write_adjacency(adjacency: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Lines ``node \\t {'neighbour': links, …}`` from rows ``src, neighbours``
    (arrays of ``dst, weight``), as ``graph.adjacency_list`` gives them. A node
    of several rows has several lines; their links belong together."""
    escaped = lambda c: F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    links = F.transform("neighbours", lambda e: F.concat(F.lit("'"), escaped(e["dst"]), F.lit("': "), e["weight"].cast("string")))
    line = F.concat(F.col("src"), F.lit("\t{"), F.array_join(links, ", "), F.lit("}"))
    adjacency.select(line.alias("value")).write.mode(mode).text(path)


def write_lines(df: DataFrame, path: str, mode: str = "overwrite", sep: str = "\t") -> None:
    """Rows as text lines of ``sep``-joined fields."""
    df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value")).write.mode(mode).text(path)


def write_model_lines(model: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Word model as lines ``word \\t c0,c1,p0,p1``."""
    payload = F.concat_ws(",", *[F.col(c).cast("string") for c in ("c0", "c1", "p0", "p1")])
    write_lines(model.select("word", payload.alias("payload")), path, mode)
