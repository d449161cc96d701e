"""Word counting, class word counts and rankings over counted words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.text import words


def tokens(docs: DataFrame, text: str | Column = "text", keep: Sequence[str] = (), lower: bool = True) -> DataFrame:
    """One row per word occurrence, with the ``keep`` columns."""
    return docs.select(*keep, F.explode(words(text, lower)).alias("word"))


def word_counts(docs: DataFrame, text: str | Column = "text", by: Sequence[str] = (), lower: bool = True) -> DataFrame:
    """``(by…, word, n)``."""
    return tokens(docs, text, by, lower).groupBy(*by, "word").agg(F.count("*").alias("n"))


def merge_counts(partials: DataFrame, keys: Sequence[str] = ("word",), n: str = "n") -> DataFrame:
    """Sum partial counts of the same key."""
    return partials.groupBy(*keys).agg(F.sum(n).alias(n))


def fold_plurals(counts: DataFrame) -> DataFrame:
    """Add the count of ``xs`` to ``x`` when both occur.

    Words that differ only in their number of trailing ``s`` form a family;
    along a run of consecutive members every second one folds into the one
    before it, as a scan in sorted order would do. A family has at most one
    member per word length, so its window is small.
    """
    family = Window.partitionBy("_base").orderBy("_s")
    run = Window.partitionBy("_base", "_run").orderBy("_s")
    members = (
        counts.withColumn("_base", F.rtrim(F.col("word"), F.lit("s")))
        .withColumn("_s", F.length("word") - F.length("_base"))
        .withColumn("_run", F.col("_s") - F.row_number().over(family))
        .withColumn("_pos", F.row_number().over(run))
        .withColumn("_plural", F.when(F.lead("_pos").over(run).isNotNull(), F.lead("n").over(run)).otherwise(F.lit(0)))
    )
    return members.where(F.col("_pos") % 2 == 1).select("word", (F.col("n") + F.col("_plural")).alias("n"))


def top_n(df: DataFrame, value: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` largest by ``value``; Spark keeps ``n`` rows per task."""
    return df.orderBy(F.desc(value), *ties).limit(n)


def bottom_n(df: DataFrame, value: str, n: int, *ties: str) -> DataFrame:
    return df.orderBy(F.asc(value), *ties).limit(n)


def top_n_by_key(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the largest key."""
    return df.orderBy(F.desc(key)).limit(n)


def top_n_per_group(df: DataFrame, group: Sequence[str], n: int, order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """Top ``n`` rows of each group.

    The rank filter lets Spark cut every task to ``n`` rows per group before
    the shuffle (``WindowGroupLimit``), so a group that holds most rows costs
    no more than any other.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def sorted_by_group(df: DataFrame, group: str, *order: Column) -> DataFrame:
    """Total order by group, then ``order``: range-partitioned, so one large
    group spreads over several tasks."""
    return df.orderBy(group, *order)


def partitioned_by_group(df: DataFrame, group: str, *order: Column, parts: int | None = None) -> DataFrame:
    """Rows clustered by group and sorted inside each partition. The order
    columns take part in the range cuts, so a large group may span several
    neighbouring partitions."""
    args = [group, *order]
    ranged = df.repartitionByRange(parts, *args) if parts else df.repartitionByRange(*args)
    return ranged.sortWithinPartitions(*args)


def class_word_counts(docs: DataFrame, label: str, text: str | Column = "text", lower: bool = True) -> DataFrame:
    """``(word, class, n)``."""
    return (
        tokens(docs, text, [label], lower)
        .groupBy("word", F.col(label).alias("class"))
        .agg(F.count("*").alias("n"))
    )


def class_word_pivot(docs: DataFrame, label: str, text: str | Column = "text") -> DataFrame:
    """``(word, c0, c1)``: occurrences in class 0 and class 1."""
    return (
        tokens(docs, text, [label])
        .groupBy("word")
        .agg(
            F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("c0"),
            F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("c1"),
        )
    )


def top_words_per_class(counts: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent words of each class from ``(word, class, n)``."""
    return top_n_per_group(counts, ["class"], n, [F.desc("n"), F.asc("word")])


def ranking_overlap(a: DataFrame, b: DataFrame, key: str = "word") -> DataFrame:
    """Percent of the keys of list ``a`` that list ``b`` also holds."""
    marked = b.select(key).distinct().withColumn("_in_b", F.lit(1))
    return (
        a.join(marked, key, "left")
        .agg(F.count("*").alias("size"), F.count("_in_b").alias("common"))
        .select("size", "common", (F.lit(100.0) * F.col("common") / F.col("size")).alias("percent"))
    )


def common_keys(a: DataFrame, b: DataFrame, key: str = "word") -> DataFrame:
    """Rows of ``a`` whose key ``b`` also holds."""
    return a.join(b.select(key), key, "left_semi")


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)
