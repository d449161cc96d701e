"""Multinomial Naive Bayes over bags of words, two classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import numeric
from millrace.functions.text import words
from millrace.operators.counting import class_word_pivot, top_n_per_group
from millrace.operators.skew import salted_join
from millrace.session import stored


def corpus_totals(docs: DataFrame, label: str, text: str | Column = "text") -> DataFrame:
    """One row: documents and words per class, vocabulary size."""
    counts = class_word_pivot(docs, label, text)
    of_words = counts.agg(
        F.sum("c0").alias("words0"), F.sum("c1").alias("words1"), F.count("*").alias("vocabulary")
    )
    of_docs = docs.agg(
        F.count_if(F.col(label) == 0).alias("docs0"), F.count_if(F.col(label) == 1).alias("docs1")
    )
    # two one-row sides
    return of_words.withColumn("_one", F.lit(1)).join(F.broadcast(of_docs.withColumn("_one", F.lit(1))), "_one").drop("_one")


def train(docs: DataFrame, label: str, text: str | Column = "text", alpha: float = 0.0) -> DataFrame:
    """``(word, c0, c1, p0, p1)`` with ``p = (c + alpha) / (words + alpha*V)``.

    ``alpha=0`` is the unsmoothed model, ``alpha=1`` Laplace smoothing. The
    three totals come from one aggregate of the word counts and enter as
    scalars.
    """
    counts = class_word_pivot(docs, label, text)
    totals = counts.agg(
        F.struct(
            F.sum("c0").alias("w0"), F.sum("c1").alias("w1"), F.count("*").alias("v")
        ).alias("t")
    )
    a = F.lit(float(alpha))
    return (
        counts.withColumn("_t", totals.scalar())
        .select(
            "word",
            "c0",
            "c1",
            ((F.col("c0") + a) / (F.col("_t.w0") + a * F.col("_t.v"))).alias("p0"),
            ((F.col("c1") + a) / (F.col("_t.w1") + a * F.col("_t.v"))).alias("p1"),
        )
    )


def class_priors(docs: DataFrame, label: str) -> DataFrame:
    """One row: ``docs0, docs1, prior0, prior1``."""
    return docs.agg(
        F.count_if(F.col(label) == 0).alias("docs0"), F.count_if(F.col(label) == 1).alias("docs1")
    ).select(
        "docs0",
        "docs1",
        (F.col("docs0") / (F.col("docs0") + F.col("docs1"))).alias("prior0"),
        (F.col("docs1") / (F.col("docs0") + F.col("docs1"))).alias("prior1"),
    )


def classify(docs: DataFrame, model: DataFrame, priors: DataFrame, doc: str, label: str, text: str | Column = "text") -> DataFrame:
    """``(doc, label, lp0, lp1, pred)`` in log space.

    Words are counted per document before they meet the model; words the
    model does not hold add nothing, and a document without words is scored
    by the priors. Common words are split over sub-keys by document.
    """
    bags = (
        docs.select(F.col(doc).alias("_doc"), F.col(label).alias("_label"), F.explode_outer(words(text)).alias("word"))
        .groupBy("_doc", "_label", "word")
        .agg(F.count("*").alias("_n"))
    )
    bags = stored(bags)  # read to measure its words, and to score them
    logs = model.select("word", numeric.safe_log(F.col("p0")).alias("_l0"), numeric.safe_log(F.col("p1")).alias("_l1"))
    scored = (
        salted_join(bags, logs, ["word"], ["_doc"], how="left")
        .groupBy("_doc", "_label")
        .agg(
            F.sum(F.coalesce(F.col("_n") * F.col("_l0"), F.lit(0.0))).alias("_s0"),
            F.sum(F.coalesce(F.col("_n") * F.col("_l1"), F.lit(0.0))).alias("_s1"),
        )
    )
    prior = priors.agg(
        F.struct(
            numeric.safe_log(F.first("prior0")).alias("l0"), numeric.safe_log(F.first("prior1")).alias("l1")
        ).alias("p")
    )
    return scored.withColumn("_p", prior.scalar()).select(
        F.col("_doc").alias(doc),
        F.col("_label").alias(label),
        (F.col("_s0") + F.col("_p.l0")).alias("lp0"),
        (F.col("_s1") + F.col("_p.l1")).alias("lp1"),
    ).withColumn("pred", numeric.predicted_class(F.col("lp0"), F.col("lp1")))


def evaluate(scored: DataFrame, label: str, pred: str = "pred") -> DataFrame:
    """One row of confusion counts and metrics; undefined ratios are null."""
    y, p = F.col(label), F.col(pred)
    counts = scored.agg(
        F.count("*").alias("docs"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return counts.select(
        "docs",
        "tp",
        "tn",
        "fp",
        "fn",
        numeric.ratio(tp + tn, F.col("docs")).alias("accuracy"),
        numeric.ratio(tp, tp + fp).alias("precision"),
        numeric.ratio(tp, tp + fn).alias("recall"),
        numeric.ratio(2 * tp, 2 * tp + fp + fn).alias("f_score"),
    )


def top_words(model: DataFrame, n: int = 10) -> DataFrame:
    """Top words per class by probability; a word belongs to its likelier class."""
    best = model.select(
        "word",
        numeric.likelier_class(F.col("p0"), F.col("p1")).alias("class"),
        F.greatest("p0", "p1").alias("p"),
    )
    return top_n_per_group(best, ["class"], n, [F.desc("p"), F.asc("word")])
