"""Session helpers: a builder with the settings the operators assume, and
the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, AQE and skew-join handling switched on.

    On a cluster leave ``master`` unset (spark-submit supplies it) and set
    ``spark.checkpoint.dir`` to a folder all executors share.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of this session.

    The cluster's ``spark.checkpoint.dir`` wins. Only a local-mode session
    that names none gets a folder of its own; on a cluster a machine-local
    folder would be lost with its machine, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-checkpoint-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result is in shared storage, so it survives
    the loss of any executor and later plans start from it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_folders: set[str] = set()


def _on_files(spark: SparkSession, path: str):
    """Hadoop's path object and the file system that holds it."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(context._jsc.hadoopConfiguration())


def scratch(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder, for files that a job writes
    and reads again. They go when the program ends, also if the session was
    stopped before."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/stored-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        path, files = _on_files(spark, folder)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _folders.add(folder)
    return f"{folder}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read
    from there: later plans start from the files, read only the columns they
    use and see the table's true size. The files go with ``discard`` or when
    the program ends.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that no later plan reads."""
    path, files = _on_files(df.sparkSession, df._stored_at)
    files.delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
