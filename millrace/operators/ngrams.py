"""N-gram tables, neighbours, vocabulary, basis and stripes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.hashing import key_fraction
from millrace.functions.text import STOP_WORDS, is_stop_word, once, space_tokens, words
from millrace.operators.counting import bottom_n, top_n
from millrace.operators.grams import ngram_counts
from millrace.operators.pairs import near_pairs, near_words


def ngram_table(docs: DataFrame, doc: str = "doc_id", text: str | Column = "text", n: int = 5, books: bool = True) -> DataFrame:
    """``(ngram, n, books)``: occurrences and number of documents.

    No row per n-gram is shuffled; see ``grams``. ``books=False`` leaves that
    column out.
    """
    table = ngram_counts(docs, doc, text, n)
    return table if books else table.select("ngram", "n")


def ngram_word_totals(grams: DataFrame) -> DataFrame:
    """Word totals, each n-gram weighted by its count."""
    return (
        grams.select(F.explode(space_tokens("ngram")).alias("word"), "n")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def neighbour_pairs(grams: DataFrame) -> DataFrame:
    """Distinct ``(a, b)`` with ``a < b``: different words that share an
    n-gram. N-gram counts do not matter, and neither does the order, so half
    of the pairs of an n-gram is enough."""
    return (
        grams.select(F.array_distinct(space_tokens("ngram")).alias("_t"))
        .select(F.explode("_t").alias("a"), "_t")
        .select("a", F.explode("_t").alias("b"))
        .where(F.col("a") < F.col("b"))
        .distinct()
    )


def _tokens(docs: DataFrame, text: str | Column, n: int) -> DataFrame:
    """Token arrays of the texts that hold an n-gram."""
    return docs.select(once(words(text)).alias("_t")).where(F.size("_t") >= n)


def text_word_totals(docs: DataFrame, text: str | Column = "text", n: int = 5) -> DataFrame:
    """``ngram_word_totals`` straight from texts: a token counts once for each
    n-gram over it, which its place tells; no n-gram is formed."""
    placed = _tokens(docs, text, n).select(F.size("_t").alias("_size"), F.posexplode("_t").alias("_i", "word"))
    over = F.least(F.col("_i") + 1, F.col("_size") - F.col("_i"), F.lit(n), F.col("_size") - n + 1)
    return placed.groupBy("word").agg(F.sum(over).alias("n"))


def _pairs_in_texts(docs: DataFrame, text: str | Column, n: int) -> DataFrame:
    """``(a, b)`` with ``a < b``, with repeats: different words less than ``n``
    apart in a text that holds an n-gram. Those are the words that share an
    n-gram. A token array is paired with itself shifted; nothing is joined."""

    def shifted(k: int) -> Column:
        length = F.size("_t") - k
        return F.arrays_zip(F.slice("_t", F.lit(1), length).alias("a"), F.slice("_t", F.lit(1 + k), length).alias("b"))

    pairs = _tokens(docs, text, n).select(F.inline(F.concat(*[shifted(k) for k in range(1, n)]))).where("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def text_neighbour_pairs(docs: DataFrame, text: str | Column = "text", n: int = 5) -> DataFrame:
    """``neighbour_pairs`` straight from texts: n-gram counts do not matter."""
    return _pairs_in_texts(docs, text, n).distinct()


def neighbour_counts(pairs: DataFrame) -> DataFrame:
    """``(word, neighbours)`` from distinct neighbour pairs: number of
    different words seen beside a word."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("word"))
    return ends.groupBy("word").agg(F.count("*").alias("neighbours"))


def text_neighbour_counts(docs: DataFrame, text: str | Column = "text", n: int = 5) -> DataFrame:
    """``neighbour_counts`` straight from texts; no pair of strings is formed
    but for long words."""
    return near_words(docs, text, n)


def word_report(totals: DataFrame, n: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vocabulary size, most and least frequent words."""
    return totals.agg(F.count("*").alias("vocabulary")), top_n(totals, "n", n, "word"), bottom_n(totals, "n", n, "word")


def neighbour_report(counts: DataFrame, n: int, fraction: float = 0.01, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words with most and fewest neighbours, and a sample of the sizes, drawn
    by the hash of the word."""
    return (
        top_n(counts, "neighbours", n, "word"),
        bottom_n(counts, "neighbours", n, "word"),
        counts.where(key_fraction("word", seed=seed) < fraction),
    )


def vocab_and_basis(totals: DataFrame, n_total: int, n_basis: int) -> DataFrame:
    """``(word, n, rank, in_basis)``: the ``n_total`` most frequent words
    without stop words; the basis is the ``n_basis`` rarest of them.

    The list has at most ``n_total`` rows, so ranking it in one window and
    broadcasting it later are both bounded by the parameter.
    """
    top = top_n(totals.where(~is_stop_word(F.col("word"))), "n", n_total, "word")
    up = Window.orderBy(F.desc("n"), F.asc("word"))
    down = Window.orderBy(F.asc("n"), F.asc("word"))
    return (
        top.withColumn("rank", F.row_number().over(up))
        .withColumn("in_basis", F.row_number().over(down) <= n_basis)
    )


def stripe_rows(pairs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Distinct ``(term, feature)``: a vocabulary word and a basis word that
    are neighbours, from pairs ``(a, b)`` that may repeat. ``vocab`` is the
    bounded list of ``vocab_and_basis``."""
    known = lambda side: F.broadcast(vocab.select(F.col("word").alias(side), F.col("in_basis").alias(f"{side}_basis")))
    both = F.array(
        F.when(F.col("b_basis"), F.struct(F.col("a").alias("term"), F.col("b").alias("feature"))),
        F.when(F.col("a_basis"), F.struct(F.col("b").alias("term"), F.col("a").alias("feature"))),
    )
    met = pairs.join(known("a"), "a").join(known("b"), "b")
    return met.select(F.inline(F.array_compact(both))).distinct()


def text_stripe_rows(docs: DataFrame, vocab: DataFrame, text: str | Column = "text", n: int = 5) -> DataFrame:
    """``stripe_rows`` straight from texts."""
    return stripe_rows(_pairs_in_texts(docs, text, n), vocab)


def stripes(rows: DataFrame) -> DataFrame:
    """``(term, stripe)`` with a sorted feature array, at most one entry per
    basis word."""
    return rows.groupBy("term").agg(F.sort_array(F.collect_set("feature")).alias("stripe"))


def window_cooccurrence(
    docs: DataFrame, doc: str | None = None, text: str | Column = "text", reach: int = 2, stop_words: list[str] | None = None
) -> DataFrame:
    """``(term, feature, n)``: words within ``reach`` positions of each other.

    Stop words are no terms and no features but keep their positions. The
    token array is paired with itself shifted by 1..``reach`` inside its row,
    so the work is linear in the text and needs no join. Pass ``doc`` to keep
    documents apart in the result; without it, pairs are formed as numbers.
    """
    if not doc:
        return near_pairs(docs, text, reach, STOP_WORDS if stop_words is None else stop_words)
    keep = [doc]
    dropped = (lambda c: c.isin(*stop_words)) if stop_words is not None else is_stop_word

    def shifted(k: int) -> Column:
        t = F.col("_t")
        length = F.greatest(F.size(t) - k, F.lit(0))
        return F.arrays_zip(F.slice(t, F.lit(1), length).alias("a"), F.slice(t, F.lit(1 + k), length).alias("b"))

    pairs = (
        docs.select(*keep, words(text).alias("_t"))
        .select(*keep, F.explode(F.concat(*[shifted(k) for k in range(1, reach + 1)])).alias("_p"))
        .select(*keep, F.col("_p.a").alias("a"), F.col("_p.b").alias("b"))
        .where((F.col("a") != F.col("b")) & ~dropped(F.col("a")) & ~dropped(F.col("b")))
    )
    counted = pairs.groupBy(*keep, "a", "b").agg(F.count("*").alias("_n"))
    both = counted.select(
        *keep,
        F.explode(F.array(F.struct(F.col("a").alias("term"), F.col("b").alias("feature")), F.struct(F.col("b").alias("term"), F.col("a").alias("feature")))).alias("_p"),
        "_n",
    ).select(*keep, "_p.term", "_p.feature", "_n")
    return both.groupBy(*keep, "term", "feature").agg(F.sum("_n").alias("n"))


def one_hot(rows: DataFrame) -> DataFrame:
    """Co-occurrence matrix in long form: ``(term, feature, value)``."""
    return rows.select("term", "feature").distinct().withColumn("value", F.lit(1))


def one_hot_wide(rows: DataFrame, features: list[str]) -> DataFrame:
    """The same as a table with one 0/1 column per listed feature."""
    return one_hot(rows).groupBy("term").pivot("feature", features).agg(F.first("value")).na.fill(0, features)
