"""Lines repeated across documents, as bitmaps of the lines to drop.

Built-in expressions only. A line's key is the line stripped of ASCII white
space with A-Z lower-cased; two 64-bit hashes stand for it.

1. Every row's distinct keys are counted, summed map-side, so a key that a
   third of all rows share moves one number per task. Only keys found in at
   least ``min_docs`` rows go on.
2. Their occurrences are range-partitioned by hash and sorted inside the
   partition by document and position; the row that starts a key's run is its
   first occurrence. A key of many occurrences has a known count and is dealt
   over parts of about ``ROWS_PER_PART`` rows, whose first rows are compared.
3. What is to be dropped becomes, per document, 64 lines to a number; numbers
   without a dropped line are left out. So do the first occurrences. Texts
   meet the bitmaps once; ``keep_first`` decides there whether a first
   occurrence stays.

Cases: null or empty text is one empty line. Keys shorter than ``min_chars``
code points are never dropped. Each row is a document, repeated rows and rows
with a null doc_id too. No rows give no rows. Other columns, of any name, are passed on by
``apply``. First is the smallest doc_id (null before all), of rows with one
doc_id the one of smallest text hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import stored

ROWS_PER_PART = 1_000_000
_BLANKS = " \t\n\u000b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(_BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _hashes(key: str) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2")]


def drop_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``doc_id, text_hash, repeated, first``: for rows that hold a line whose
    key is found in ``min_docs`` rows, maps from ``position div 64`` to the
    bits of all such lines, and of those that are the first of their key."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.transform(lines("text"), line_key).alias("keys"),
    )
    long_enough = F.char_length("key") >= min_chars
    counts = (
        rows.select(F.explode(F.array_distinct("keys")).alias("key")).where(long_enough)
        .select(*_hashes("key"))
        .groupBy("h1", "h2").agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_docs)
    )
    occurrences = rows.select("doc_id", "text_hash", F.posexplode("keys").alias("pos", "key")).where(long_enough)
    occurrences = occurrences.select("doc_id", "text_hash", "pos", *_hashes("key"))
    repeated = stored(occurrences.join(stored(counts), ["h1", "h2"]))

    order = ["doc_id", "text_hash", "pos"]
    parts = F.ceil(F.col("n") / ROWS_PER_PART)
    dealt = repeated.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_hash"), parts)).withColumn("split", parts > 1)
    run = Window.partitionBy("h1", "h2", "part").orderBy(*order)
    found = dealt.repartitionByRange("h1", "h2", "part").withColumn("starts_run", F.row_number().over(run) == 1)
    # of a key in several parts, one row per part
    runs = found.where(F.col("split") & F.col("starts_run")).groupBy("h1", "h2").agg(F.min(F.struct(*order)).alias("least"))
    found = found.join(runs, ["h1", "h2"], "left")
    first = F.col("starts_run") & (~F.col("split") | F.struct(*order).eqNullSafe(F.col("least")))
    word = F.floor(F.col("pos") / 64).alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("pos") % 64).cast("int"))
    words = found.groupBy("doc_id", "text_hash", word).agg(F.bit_or(bit).alias("bits"), F.bit_or(F.when(first, bit)).alias("first"))
    every, firsts = F.struct("word", "bits"), F.when(F.col("first").isNotNull(), F.struct("word", "first"))
    return words.groupBy("doc_id", "text_hash").agg(
        F.map_from_entries(F.collect_list(every)).alias("repeated"), F.map_from_entries(F.collect_list(firsts)).alias("first")
    )


def apply(docs: DataFrame, bitmaps: DataFrame, keep_first: bool = False) -> DataFrame:
    """``doc`` (the row of ``docs``, with ``text`` replaced by its kept
    lines), ``n_lines`` (before), ``n_dropped`` and ``n_first`` (lines that are
    the first of a repeated key). With ``keep_first`` those stay."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("doc")).withColumns({"id": F.col("doc.doc_id").cast("long"), "hash": F.xxhash64("doc.text")})
    marks = bitmaps.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "repeated", "first")
    joined = rows.join(marks, F.col("of_id").eqNullSafe(F.col("id")) & (F.col("of_hash") == F.col("hash")), "left")
    joined = joined.select("doc", "repeated", "first", lines("doc.text").alias("lines"))
    last = F.floor((F.size("lines") - 1) / 64)
    none = F.lit(0).cast("long")

    def word(w: Column) -> Column:
        dropped = F.coalesce(F.try_element_at("repeated", w), none)
        return dropped.bitwiseAND(F.bitwise_not(F.coalesce(F.try_element_at("first", w), none))) if keep_first else dropped

    dense = F.transform(F.sequence(none, last), word)
    joined = joined.withColumn("bits", F.when(F.col("repeated").isNotNull(), dense))

    def stays(_, i):
        return F.call_function("shiftright", F.get("bits", F.floor(i / 64).cast("int")), (i % 64).cast("int")).bitwiseAND(1) == 0

    kept = joined.withColumn("kept", F.when(F.col("bits").isNull(), F.col("lines")).otherwise(F.filter("lines", stays)))
    firsts = F.aggregate(F.map_values("first"), F.lit(0), lambda n, bits: n + F.bit_count(bits))
    return kept.select(
        F.col("doc").withField("text", F.array_join("kept", "\n")).alias("doc"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.coalesce(firsts, F.lit(0)).cast("long").alias("n_first"),
    )


ORACLE_SQL = f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
places AS (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM parts),
keyed AS (
  SELECT doc_id, i, p[i] AS line,
    translate(trim(p[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key
  FROM places),
common AS (SELECT key, min((doc_id, i)) AS first FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped, count(*) FILTER (first = (doc_id, i)) AS n_first,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common ON keyed.key = common.key
GROUP BY doc_id
"""
