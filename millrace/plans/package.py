"""The packaged run: all that scoring needs as one versioned artefact, and
batch scoring that takes up only files it has not scored yet.

A version is a folder ``v000001`` with model, delay index, station index and
feature list. A scored batch is a folder ``batch-000001`` with its scores and
the list of the files they come from. Either is written under another name
and put in place by one rename, which fails if the name is taken: a reader
sees the whole of it or nothing, and a job that dies leaves nothing behind
that counts.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from millrace.operators.classify import load_model, save_model
from millrace.plans import flights
from millrace.sources.readers import parquet
from millrace.sources.writers import write_parquet


@dataclass(frozen=True)
class Package:
    version: str
    model: PipelineModel
    delay_index: DataFrame
    stations: DataFrame
    features: list[str]


def _hadoop(spark: SparkSession, path: str):
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(context._jsc.hadoopConfiguration())


def _numbered(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Names ``<prefix><number>`` in the folder, in order."""
    path, files = _hadoop(spark, folder)
    if not files.exists(path):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path)]
    return sorted(n for n in names if re.fullmatch(f"{prefix}[0-9]{{6,}}", n))


def _put(spark: SparkSession, made: str, folder: str, prefix: str) -> str:
    """Give the finished folder ``made`` the next number."""
    context = spark.sparkContext
    fs = context._jvm.org.apache.hadoop.fs
    source, files = _hadoop(spark, made)
    plain = context._gateway.new_array(fs.Options.Rename, 0)
    place = fs.FileContext.getFileContext(files.getUri(), context._jsc.hadoopConfiguration())
    while True:
        taken = _numbered(spark, folder, prefix)
        name = f"{prefix}{int(taken[-1].removeprefix(prefix)) + 1 if taken else 1:06d}"
        target, _ = _hadoop(spark, f"{folder}/{name}")
        try:
            place.rename(source, target, plain)
            return name
        except Exception:
            # another job may have taken the number; anything else is an error
            if name not in _numbered(spark, folder, prefix):
                raise


def publish(spark: SparkSession, folder: str, model: PipelineModel, delay_index: DataFrame, stations: DataFrame, features: Sequence[str]) -> str:
    """Write a new version; returns its name."""
    made = f"{folder}/_new-{uuid.uuid4().hex}"
    save_model(model, f"{made}/model")
    write_parquet(delay_index, f"{made}/delay_index")
    write_parquet(stations, f"{made}/stations")
    write_parquet(spark.createDataFrame([*enumerate(features)], "place int, feature string"), f"{made}/features")
    return _put(spark, made, folder, "v")


def load(spark: SparkSession, folder: str, version: str | None = None) -> Package:
    """A version, by default the newest."""
    if version is None:
        known = _numbered(spark, folder, "v")
        if not known:
            raise FileNotFoundError(f"no version in {folder}")
        version = known[-1]
    at = f"{folder}/{version}"
    names = [r.feature for r in parquet(spark, f"{at}/features").orderBy("place").collect()]  # one row per feature
    return Package(version, load_model(f"{at}/model"), parquet(spark, f"{at}/delay_index"), parquet(spark, f"{at}/stations"), names)


def scored_files(spark: SparkSession, out: str) -> DataFrame:
    """``(file, version)`` of every file in a finished batch."""
    done = _numbered(spark, out, "batch-")
    if not done:
        return spark.createDataFrame([], "file string, version string")
    return parquet(spark, [f"{out}/{b}/files" for b in done])


def scores(spark: SparkSession, out: str) -> DataFrame:
    """The scores of all finished batches."""
    return parquet(spark, [f"{out}/{b}/scores" for b in _numbered(spark, out, "batch-")])


def score_new(spark: SparkSession, folder: str, flight_paths, weather_paths, out: str, keep: Sequence[str] = ()) -> str | None:
    """Score the flight files that no finished batch in ``out`` lists yet with
    the newest version in ``folder``. Returns the batch's name, or None if
    there is no new file."""
    listed = spark.createDataFrame([(f,) for f in parquet(spark, flight_paths).inputFiles()], "file string")
    new = [r.file for r in listed.join(scored_files(spark, out), "file", "left_anti").orderBy("file").collect()]
    if not new:
        return None
    use = load(spark, folder)
    made = f"{out}/_new-{uuid.uuid4().hex}"
    found = flights.score_flights(spark, use.model, new, weather_paths, None, use.delay_index, use.stations, use.features, keep)
    write_parquet(found, f"{made}/scores")
    write_parquet(spark.createDataFrame([(f, use.version) for f in new], "file string, version string"), f"{made}/files")
    return _put(spark, made, out, "batch-")
