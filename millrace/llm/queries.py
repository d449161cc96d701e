"""The registered queries of this subpackage: each applies its operator, with
production parameters, to the whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm import decontaminate, licenses, lines, neighbours, packing, quality, ranking, secrets, simhash, suffix, token_file, toxicity, trie
from millrace.sources.readers import table

TOKENIZER = "byte_bpe_50k.json"
SECRETS_VOCABULARY = "byte_bpe_50k.tiktoken"
END_ID = 2


ACCEPTED = 0.7


def _remainder(divisor: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def _scored(docs: DataFrame, score: Column, held_out: Column) -> DataFrame:
    scored = docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPTED).cast("int"))


def quality_model(spark: SparkSession, docs: DataFrame, folder: str) -> quality.Model:
    return quality.learn(docs, table(spark, folder, "labels").where(_remainder(4) != 2))


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality_model(spark, docs, folder)
    return _scored(docs, quality.score(model, F.col("text")), _remainder(4) == 2)


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.col("n_hit").cast("long").alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), END_ID)


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.learn(docs, table(spark, folder, "labels").where(_remainder(3) != 1))
    return _scored(docs, toxicity.score(model, F.col("text")), _remainder(3) == 1)


def op6_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = lines.apply(docs, lines.drop_bitmaps(docs))
    return found.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("doc.text", 256).alias("kept_sha256"), "n_first")


def op8_token_file(spark: SparkSession, folder: str) -> DataFrame:
    return token_file.read(token_file.write(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), END_ID))


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    found = ranking.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op12_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"), public_tokenizers.path(SECRETS_VOCABULARY))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.joined("spans", base_only=True), 256).alias("base_sha256"), secrets.joined("spans", base_only=False).alias("spans")
    )


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    conv_id = F.col("conv_id")
    shared = F.crc32(conv_id.cast("string").cast("binary")) % 6
    lists = trie.share_openings(trie.turn_lists(table(spark, folder, "conversations")), conv_id - conv_id % 100, shared, 5)
    return trie.nodes(lists)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_decontamination": op2_decontamination,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_neighbours": op6_neighbours,
    "op7_line_dedup": op7_line_dedup,
    "op8_token_file": op8_token_file,
    "op9_licenses": op9_licenses,
    "op10_simhash": op10_simhash,
    "op11_ranked_search": op11_ranked_search,
    "op12_secrets": op12_secrets,
    "op13_conversation_trie": op13_conversation_trie,
}
ORACLE_SQL = {
    "op2_decontamination": decontaminate.ORACLE_SQL,
    "op4_suffix_dedup": suffix.ORACLE_SQL,
    "op7_line_dedup": lines.ORACLE_SQL,
    "op11_ranked_search": ranking.ORACLE_SQL,
    "op13_conversation_trie": trie.ORACLE_SQL,
}
