"""All registered queries: name -> (Spark function, equivalent SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.counting import top_n_per_group, word_counts
from millrace.plans import file_queries, model_queries, table_queries, text_queries
from millrace.sources.readers import table

PARTS = (text_queries, table_queries, model_queries, file_queries)


def entries() -> dict:
    out: dict = {}
    for part in PARTS:
        clash = out.keys() & part.QUERIES.keys()
        if clash:
            raise ValueError(f"query registered twice: {sorted(clash)}")
        out.update(part.QUERIES)
    return out


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    counts = word_counts(table(spark, folder, "documents"), by=["lang"])
    return top_n_per_group(counts, ["lang"], 20, [F.desc("n"), F.asc("word")])
