"""Registered round trips: a given table goes to files of one format in the
shared folder, and the scan of that format reads the files back.

Each writes the whole table with the library's sink, in as many files as there
are tasks, and returns what the scan finds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import graph, naive_bayes
from millrace.plans import derived, text_queries
from millrace.plans.model_queries import EDGES
from millrace.session import scratch
from millrace.sources import readers, writers
from millrace.sources.readers import spread, table


def _text_lines(spark, d):
    """Texts as line files; a text of several lines gives several records."""
    path = scratch(spark)
    writers.write_lines(spread(table(spark, d, "documents")).select("text"), path)
    return readers.text_lines(spark, path, line_sep="\n").groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


def _mail(spark, d):
    """Labelled documents as mail records: the first line is the subject."""
    path = scratch(spark)
    parts = text_queries._mail_parts(spark, d)
    records = parts.select(F.concat(F.lit("d"), "doc_id").alias("id"), F.col("quality").cast("int").alias("spam"), "subject", "content")
    writers.write_tsv(records, path)
    return readers.mail(spark, path)


def _flat(c: str) -> str:
    return f"nullif(translate({c}, chr(9) || chr(10) || chr(13), '   '), '')"


def _ngram_files(spark, d):
    """5-grams with their counts in both places where the format has pages.
    The files are several times as long as the texts, so they are gzipped."""
    path = scratch(spark)
    table = text_queries._grams(spark, d, books=True).select("ngram", "n", F.col("n").alias("pages"), "books")
    writers.write_tsv(table, path, compression="gzip")
    return readers.ngram_file(spark, path)


MEASURES = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
_MEASURED = "l_orderkey bigint, l_linenumber bigint, " + ", ".join(f"{c} double" for c in MEASURES)


def _tagged(spark, d):
    """Order lines of each status in files of their own; the tag tells them."""
    lines, tagged = table(spark, d, "lineitem"), []
    for status, tag in (("F", 1), ("O", 0)):
        path = scratch(spark)
        writers.write_delimited(lines.where(F.col("l_linestatus") == status).select("l_orderkey", "l_linenumber", *MEASURES), path, ";")
        tagged.append((path, tag))
    return readers.tagged_union(spark, tagged, _MEASURED, "tag")


def _features(spark, d):
    """Unheaded number records; the last one is the label."""
    path = scratch(spark)
    writers.write_delimited(table(spark, d, "lineitem").select("l_orderkey", *MEASURES), path, ",", header=False)
    read = readers.features_and_label(readers.delimited(spark, path, _MEASURED.replace(" l_linenumber bigint,", ""), ",", header=False))
    return read.select(*[F.get("features", F.lit(i)).alias(f"x{i}") for i in range(len(MEASURES))], "label")


def _glob(spark, d):
    """Orders in many files, read through a pattern over the files' names."""
    path = scratch(spark)
    writers.write_parquet(spread(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")), path)
    return readers.parquet(spark, f"{path}/part-*.parquet")


def _listed(spark, d):
    """The same from a list of folders, one per priority."""
    path = scratch(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderkey") % 3)
    writers.write_parquet(orders.toDF("o_orderkey", "o_custkey", "rest"), path, ["rest"])
    return readers.parquet(spark, [f"{path}/rest={i}" for i in range(3)])


_AIRPORT_FILE = ["SEQ", "LONGITUDE", "AIRPORT_ID", "REMARK", "DISPLAY_AIRPORT_NAME", "LATITUDE"]


def _airports(spark, d):
    """Airport rows in a wider headed file with its columns in another order,
    quoted names and a remark that is empty or holds the separator."""
    path = scratch(spark)
    rows = derived.airport_rows(spark, d).withColumn("DISPLAY_AIRPORT_NAME", F.concat(F.col("DISPLAY_AIRPORT_NAME"), F.lit(', "North"')))
    wide = rows.withColumns({"SEQ": F.col("AIRPORT_ID") * 2, "REMARK": F.when(F.col("AIRPORT_ID") % 2 == 0, F.lit('a,"b",c')).when(F.col("AIRPORT_ID") % 3 == 0, F.lit(""))})
    writers.write_delimited(wide.select(_AIRPORT_FILE), path)
    return readers.airport_coordinates(spark, path, _AIRPORT_FILE).groupBy("AIRPORT_ID", "DISPLAY_AIRPORT_NAME").agg(
        F.count("*").alias("rows"), F.round(F.sum("LATITUDE"), 6).alias("latitudes"), F.round(F.sum("LONGITUDE"), 6).alias("longitudes")
    )


def _adjacency(spark, d):
    path = scratch(spark)
    writers.write_adjacency(graph.adjacency_list(derived.trade_edges(spark, d)), path)
    return readers.adjacency_edges(spark, path).select("src", "dst", F.col("weight").cast("bigint").alias("weight"))


def _titles(spark, d):
    path = scratch(spark)
    records = table(spark, d, "customer").select(F.concat(F.col("c_name"), F.lit(' "'), F.col("c_mktsegment"), F.lit('"')), F.concat(F.lit("c"), F.col("c_custkey")), "c_nationkey", F.col("c_custkey") % 7)
    writers.write_tsv(records.toDF("title", "id", "in_deg", "out_deg"), path)
    return readers.titles(spark, path)


def _word_model(spark, d):
    """A trained word model, saved as lines and read back to classify with."""
    path = scratch(spark)
    writers.write_model_lines(naive_bayes.train(derived.labelled_documents(spark, d), "quality", alpha=1.0), path)
    return readers.saved_model(spark, path).withColumns({c: F.round(c, 10) for c in ("p0", "p1")})


def _vocabulary(spark, d):
    path = scratch(spark)
    writers.write_parquet(text_queries._vocab(spark, d), path)
    kept = readers.parquet(spark, path, "word string, n bigint, rank int, in_basis boolean")
    return kept.withColumns({"rank": F.col("rank").cast("bigint"), "in_basis": F.col("in_basis").cast("int")})


def _word_lines(spark, d):
    """Word counts as ``word \\t n`` text, merged from all files of the sink."""
    path = scratch(spark)
    counts = text_queries.QUERIES["word_count"][0](spark, d)
    writers.write_lines(counts, path)
    fields = F.split("value", "\t")
    return readers.text_lines(spark, path).select(F.get(fields, F.lit(0)).alias("word"), F.get(fields, F.lit(1)).cast("bigint").alias("n"))


QUERIES = {
    "file_text_lines": (
        _text_lines,
        "SELECT line, count(*) AS n FROM (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents) GROUP BY line",
    ),
    "file_mail": (
        _mail,
        f"""WITH m AS (SELECT 'd' || doc_id AS id, quality::INT AS spam, text, instr(text, chr(10)) AS cut FROM documents JOIN labels USING (doc_id))
 SELECT id, spam, {_flat("CASE WHEN cut > 0 THEN substr(text, 1, cut - 1) ELSE text END")} AS subject, {_flat("CASE WHEN cut > 0 THEN substr(text, cut + 1) END")} AS content FROM m""",
    ),
    "file_ngrams": (_ngram_files, f"WITH {text_queries.GRAMS} SELECT ngram, n, n AS pages, books FROM grams"),
    "file_tagged_union": (
        _tagged,
        f"SELECT l_orderkey, l_linenumber, {', '.join(MEASURES)}, (l_linestatus = 'F')::INT AS tag FROM lineitem WHERE l_linestatus IN ('F', 'O')",
    ),
    "file_features_and_label": (
        _features,
        "SELECT l_orderkey::DOUBLE AS x0, l_quantity::DOUBLE AS x1, l_discount::DOUBLE AS x2, l_tax::DOUBLE AS x3, l_extendedprice::DOUBLE AS label FROM lineitem",
    ),
    "file_parquet_glob": (_glob, "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders"),
    "file_parquet_list": (_listed, "SELECT o_orderkey, o_custkey FROM orders"),
    "file_by_header": (
        _airports,
        """SELECT s_nationkey AS AIRPORT_ID, 'Airport ' || s_nationkey || ', "North"' AS DISPLAY_AIRPORT_NAME, count(*) AS rows,
 round(sum((s_nationkey * 5281) % 1801 / 10.0::DOUBLE - 90 + s_suppkey % 8 / 8.0::DOUBLE), 6) AS latitudes,
 round(sum((s_nationkey * 31337) % 3601 / 10.0::DOUBLE - 180 + s_suppkey % 4 / 4.0::DOUBLE), 6) AS longitudes FROM supplier GROUP BY s_nationkey""",
    ),
    "file_adjacency": (_adjacency, f"WITH {EDGES} SELECT src, dst, weight FROM ed"),
    "file_titles": (
        _titles,
        """SELECT c_name || ' "' || c_mktsegment || '"' AS title, 'c' || c_custkey AS id, c_nationkey AS in_deg, c_custkey % 7 AS out_deg FROM customer""",
    ),
    "file_word_model": (_word_model, text_queries.QUERIES["nb_train_smoothed"][1]),
    "file_vocabulary": (_vocabulary, text_queries.QUERIES["vocab_and_basis"][1]),
    "file_word_lines": (_word_lines, text_queries.QUERIES["word_count"][1]),
}
