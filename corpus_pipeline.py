"""The corpus pipeline: documents that the quality classifier rejects go,
lines repeated across documents go, one document of each group of near copies
stays, documents with benchmark passages go, and the rest is packed into
token sequences.

Each stage takes and returns documents with all their columns (``n_chars``
follows the text); the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import decontaminate, lines, packing, quality, queries, simhash
from millrace.session import discard, stored
from millrace.sources.readers import table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = queries.quality_model(spark, docs, sf_dir)
    return docs.where(quality.score(model, F.col("text")) >= queries.ACCEPTED)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = lines.apply(docs, lines.drop_bitmaps(docs))
    if "n_chars" in docs.columns:
        length = F.char_length("doc.text").cast(docs.schema["n_chars"].dataType)
        # a text that lost nothing keeps its entry
        found = found.withColumn("doc", F.when(F.col("n_dropped") > 0, F.col("doc").withField("n_chars", length)).otherwise(F.col("doc")))
    return found.select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(queries.TOKENIZER), queries.END_ID)


STAGES = [
    ("quality_filter", quality_filter),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None  # a trained model, tokenizer ids and XXH64 have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
