"""The row-stream jobs on Structured Streaming: the same operators fed by
``readStream``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.counting import word_counts


def text_stream(spark: SparkSession, folder: str, files_per_batch: int = 64) -> DataFrame:
    """``(value)`` lines of files as they arrive in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)


def running_word_counts(lines: DataFrame) -> DataFrame:
    """Running ``(word, n)``; the state is one count per word."""
    return word_counts(lines, "value")


def write_counts(counts: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Writes the counts after each batch to a Parquet folder of its own,
    processes what is there and ends. A batch that is repeated replaces its
    folder."""
    return (
        counts.writeStream.outputMode("complete")
        .foreachBatch(lambda df, batch: df.write.mode("overwrite").parquet(f"{folder}/batch={batch}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
