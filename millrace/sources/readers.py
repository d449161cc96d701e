"""Scans. Every reader states its schema, so no file is read twice."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.operators.graph import edges_from_adjacency

MAIL = "id string, spam int, subject string, content string"
NGRAMS = "ngram string, n bigint, pages bigint, books bigint"
TITLES = "title string, id string, in_deg bigint, out_deg bigint"
AIRPORT_COORDINATES = "AIRPORT_ID int, DISPLAY_AIRPORT_NAME string, LATITUDE double, LONGITUDE double"
WINE_FEATURES = (
    "fixed_acidity volatile_acidity citric_acid residual_sugar chlorides free_sulfur_dioxide "
    "total_sulfur_dioxide density pH sulphates alcohol"
).split()
WINE = ", ".join(f"{c} double" for c in [*WINE_FEATURES, "quality"])


def _paths(paths: str | Iterable[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def text_lines(spark: SparkSession, paths: str | Iterable[str], line_sep: str | None = None) -> DataFrame:
    """``(value)`` per line of one file, several files or whole folders. Any of
    the usual line ends counts unless ``line_sep`` names one."""
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    return reader.text(_paths(paths))


def tsv(spark: SparkSession, paths: str | Iterable[str], schema: str | T.StructType) -> DataFrame:
    """Tab-separated records; quotes are ordinary characters and an empty field
    is null."""
    return spark.read.schema(schema).option("sep", "\t").option("quote", "").csv(_paths(paths))


def mail(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    return tsv(spark, paths, MAIL)


def ngram_file(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    return tsv(spark, paths, NGRAMS)


def titles(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    return tsv(spark, paths, TITLES)


def delimited(spark: SparkSession, paths: str | Iterable[str], schema: str, sep: str = ",", header: bool = True) -> DataFrame:
    """Delimited records. A field without anything is null, a quoted empty one
    the empty string."""
    options = {"header": header, "sep": sep, "escape": '"', "nullValue": "\0"}  # else both would be null
    return spark.read.schema(schema).options(**options).csv(_paths(paths))


def features_and_label(rows: DataFrame) -> DataFrame:
    """``(features, label)`` of all-numeric rows whose last column is the label."""
    *features, label = rows.columns
    return rows.select(F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("features"), F.col(f"`{label}`").cast("double").alias("label"))


def tagged_union(spark: SparkSession, tagged: Sequence[tuple[str, int]], schema: str, tag: str, sep: str = ";") -> DataFrame:
    """Headed files of one schema, each with a constant tag, as one table."""
    out = None
    for path, value in tagged:
        part = delimited(spark, path, schema, sep).withColumn(tag, F.lit(value))
        out = part if out is None else out.unionByName(part)
    return out


def wine(spark: SparkSession, red: str, white: str) -> DataFrame:
    """Both wine files; ``color`` is 1 for red and 0 for white."""
    return tagged_union(spark, [(red, 1), (white, 0)], WINE, "color").select("color", *WINE_FEATURES, "quality")


def by_header(spark: SparkSession, paths: str | Iterable[str], wanted: str, header: Sequence[str] | None = None) -> DataFrame:
    """The columns ``wanted`` (a schema) of headed comma-separated files that
    hold more, in any order; a value that does not parse is null.

    ``header`` states the files' column names: then nothing is read before the
    scan, and each file's own header is checked against it. Without it Spark
    reads the first line of one file beforehand.
    """
    types = {f.name: f.dataType for f in T.StructType.fromDDL(wanted)}
    reader = spark.read.options(header=True, escape='"', nullValue="\0")
    if header is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in header])).option("enforceSchema", False)
    return reader.csv(_paths(paths)).select(*[F.col(f"`{c}`").try_cast(types[c]).alias(c) for c in types])


def airport_coordinates(spark: SparkSession, path: str, header: Sequence[str] | None = None) -> DataFrame:
    """The four columns in use, found by name in a wider headed file."""
    return by_header(spark, path, AIRPORT_COORDINATES, header)


def parquet(spark: SparkSession, paths: str | Iterable[str], schema: str | T.StructType | None = None) -> DataFrame:
    """Parquet from a path, a list of paths or a glob."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*_paths(paths))


def adjacency_edges(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """``(src, dst, weight)`` from lines ``node \\t {'neighbour': links}``."""
    return edges_from_adjacency(text_lines(spark, paths))


def saved_model(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Word model from lines ``word \\t c0,c1,p0,p1``."""
    raw = tsv(spark, paths, "word string, payload string")
    part = F.split("payload", ",")
    return raw.select(
        "word",
        F.get(part, F.lit(0)).try_cast("double").cast("bigint").alias("c0"),
        F.get(part, F.lit(1)).try_cast("double").cast("bigint").alias("c1"),
        F.get(part, F.lit(2)).try_cast("double").alias("p0"),
        F.get(part, F.lit(3)).try_cast("double").alias("p1"),
    )


def literal(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table typed into the program."""
    return spark.createDataFrame(list(rows), schema)


SMALL_SCAN = 32  # splits; at Spark's default split size, 4 GB


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small scan over all cores.

    Meant for tables whose rows are expensive to work on, such as texts. Only
    a table of fewer splits than cores, and of ``SMALL_SCAN`` at most, is
    moved; any larger one is read where it lies.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(cores) if splits < min(cores, SMALL_SCAN + 1) else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Run SQL text over the given DataFrames, named as keyword arguments."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
