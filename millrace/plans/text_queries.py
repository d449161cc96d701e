"""Registered text queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import numeric
from millrace.functions.text import STOP_WORDS, is_stop_word, join_text, once
from millrace.operators import counting, naive_bayes, ngrams, sampling, similarity, skew
from millrace.plans.derived import labelled_documents
from millrace.session import stored
from millrace.sources.readers import spread, table

N_TOTAL, N_BASIS = 10_000, 1_000
JACCARD = 0.8

WORDS = "words AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents)"
LABELLED = """labelled AS (SELECT d.doc_id, d.text, l.quality,
   ('0x' || substr(md5('42|' || d.doc_id), 1, 8))::BIGINT / 4294967296.0 < 0.8 AS is_train
   FROM documents d JOIN labels l USING (doc_id)),
 lw AS (SELECT doc_id, quality, is_train, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM labelled)"""
GRAMS = """toks AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS t FROM documents),
 placed AS (SELECT doc_id, unnest(t) AS w, unnest(range(len(t))) AS i FROM toks),
 runs AS (SELECT doc_id, w AS w1, lead(w, 1) OVER x AS w2, lead(w, 2) OVER x AS w3, lead(w, 3) OVER x AS w4, lead(w, 4) OVER x AS w5
   FROM placed WINDOW x AS (PARTITION BY doc_id ORDER BY i)),
 grams AS (SELECT w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 AS ngram, count(*) AS n, count(DISTINCT doc_id) AS books
   FROM runs WHERE w5 IS NOT NULL GROUP BY 1)"""
TOTALS = "totals AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT unnest(string_split(ngram, ' ')) AS word, n FROM grams) GROUP BY word)"
GRAM_WORDS = "gw AS (SELECT DISTINCT ngram, unnest(string_split(ngram, ' ')) AS word FROM grams)"
NEIGHBOURS = GRAM_WORDS + """,
 nb AS (SELECT a.word, count(DISTINCT b.word) AS neighbours FROM gw a JOIN gw b ON a.ngram = b.ngram AND a.word <> b.word GROUP BY a.word)"""
_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)
VOCAB = f"""top AS (SELECT word, n FROM totals WHERE word NOT IN ({_STOP}) ORDER BY n DESC, word LIMIT {N_TOTAL}),
 vocab AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS rank,
   CASE WHEN row_number() OVER (ORDER BY n, word) <= {N_BASIS} THEN 1 ELSE 0 END AS in_basis FROM top)"""
STRIPES = GRAM_WORDS + """,
 sr AS (SELECT DISTINCT a.word AS term, b.word AS feature FROM gw a JOIN gw b ON a.ngram = b.ngram AND a.word <> b.word
   WHERE a.word IN (SELECT word FROM vocab) AND b.word IN (SELECT word FROM vocab WHERE in_basis = 1))"""
PAIRS = """sz AS (SELECT term, count(*) AS n FROM sr GROUP BY term),
 sp AS (SELECT a.term AS a, b.term AS b, count(*) AS shared FROM sr a JOIN sr b ON a.feature = b.feature AND a.term < b.term GROUP BY 1, 2),
 scored AS (SELECT a, b, shared / sqrt((x.n * y.n)::DOUBLE) AS cosine, shared / (x.n + y.n - shared) AS jaccard,
   shared / least(x.n, y.n) AS overlap, 2 * shared / (x.n + y.n) AS dice FROM sp JOIN sz x ON x.term = a JOIN sz y ON y.term = b)"""
ROUNDED_PAIRS = "a, b, round(cosine, 6) AS cosine, round(jaccard, 6) AS jaccard, round(overlap, 6) AS overlap, round(dice, 6) AS dice"
CHAIN = f"WITH {GRAMS}, {TOTALS}, {VOCAB}, {STRIPES}"


def _docs(spark, d):
    return spread(table(spark, d, "documents"))


def _mail_parts(spark, d):
    """Labelled documents as mail: the first line is the subject."""
    cut = F.split("text", "\n", 2)
    return labelled_documents(spark, d).select("doc_id", "quality", F.get(cut, F.lit(0)).alias("subject"), F.get(cut, F.lit(1)).alias("content"))


def _grams(spark, d, books=False):
    return ngrams.ngram_table(_docs(spark, d).select("doc_id", "text"), books=books)


def _vocab(spark, d):
    return ngrams.vocab_and_basis(ngrams.text_word_totals(_docs(spark, d)), N_TOTAL, N_BASIS)


def _stripe_rows(spark, d):
    vocab = stored(_vocab(spark, d))  # at most N_TOTAL rows, met by both ends of a pair
    return ngrams.text_stripe_rows(_docs(spark, d), vocab)


def _neighbours(spark, d):
    return ngrams.text_neighbour_counts(_docs(spark, d))


def _rounded(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _scored(df):
    return _rounded(df, 6, "cosine", "jaccard", "overlap", "dice")


def _two_rankings(spark, d):
    """The 1000 most frequent words and the 1000 with most neighbours."""
    a = counting.top_n(ngrams.text_word_totals(_docs(spark, d)), "n", 1000, "word")
    return a, counting.top_n(_neighbours(spark, d), "neighbours", 1000, "word")


def _overlap(spark, d):
    return _rounded(counting.ranking_overlap(*_two_rankings(spark, d)), 6, "percent")


def _common(spark, d):
    return counting.common_keys(*_two_rankings(spark, d))


def _report(spark, d):
    """The 20 most similar pairs as printed lines."""
    top = similarity.term_similarity_extremes(ngrams.stripes(_stripe_rows(spark, d)), 20, N_TOTAL, "top")
    scores = ("cosine", "jaccard", "overlap", "dice")
    return top.select(F.concat_ws(" - ", "a", "b").alias("pair"), *[numeric.fixed(c, 4).alias(c) for c in scores])


def _document_words(spark, d):
    """Every document with its sorted set of words."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    return _docs(spark, d).select(F.col("doc_id").alias("item"), once(F.sort_array(F.array_distinct(words))).alias("features"))


def _split(spark, d):
    return sampling.hash_split(labelled_documents(spark, d), ["doc_id"])


def _scored_mail(spark, d):
    docs = _split(spark, d)
    train = docs.where("is_train")
    model = naive_bayes.train(train, "quality", alpha=1.0)
    return naive_bayes.classify(docs.where("NOT is_train"), model, naive_bayes.class_priors(train, "quality"), "doc_id", "quality")


def _nb_sql(select: str) -> str:
    return f"""WITH {LABELLED},
 c AS (SELECT word, count(*) FILTER (quality = 0) AS c0, count(*) FILTER (quality = 1) AS c1 FROM lw WHERE is_train GROUP BY word),
 m AS (SELECT word, (c0 + 1) / ((SELECT sum(c0) FROM c) + (SELECT count(*) FROM c)) AS p0,
   (c1 + 1) / ((SELECT sum(c1) FROM c) + (SELECT count(*) FROM c)) AS p1 FROM c),
 pr AS (SELECT ln(avg(1.0 - quality)) AS l0, ln(avg(quality::DOUBLE)) AS l1 FROM labelled WHERE is_train),
 s AS (SELECT t.doc_id, t.quality, (SELECT l0 FROM pr) + coalesce(sum(ln(m.p0)), 0) AS lp0, (SELECT l1 FROM pr) + coalesce(sum(ln(m.p1)), 0) AS lp1
   FROM labelled t LEFT JOIN lw ON lw.doc_id = t.doc_id LEFT JOIN m ON m.word = lw.word WHERE NOT t.is_train GROUP BY 1, 2),
 p AS (SELECT *, CASE WHEN lp1 > lp0 THEN 1 ELSE 0 END AS pred FROM s)
 {select}"""


QUERIES = {
    "word_count": (lambda s, d: counting.word_counts(_docs(s, d)), f"WITH {WORDS} SELECT word, count(*) AS n FROM words GROUP BY word"),
    "word_count_by_lang": (
        lambda s, d: counting.word_counts(_docs(s, d), by=["lang"]),
        f"WITH {WORDS} SELECT lang, word, count(*) AS n FROM words GROUP BY lang, word",
    ),
    "word_count_case_kept": (
        lambda s, d: counting.word_counts(_docs(s, d), lower=False),
        "SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS word FROM documents) GROUP BY word",
    ),
    "word_count_merged": (
        lambda s, d: counting.merge_counts(counting.word_counts(_docs(s, d), by=["source"])),
        f"WITH {WORDS} SELECT word, count(*) AS n FROM words GROUP BY word",
    ),
    "word_top_n": (
        lambda s, d: counting.top_n(counting.word_counts(_docs(s, d)), "n", 100, "word"),
        f"WITH {WORDS} SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n DESC, word LIMIT 100",
    ),
    "word_bottom_n": (
        lambda s, d: counting.bottom_n(counting.word_counts(_docs(s, d)), "n", 100, "word"),
        f"WITH {WORDS} SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n, word LIMIT 100",
    ),
    "word_top_n_by_key": (
        lambda s, d: counting.top_n_by_key(counting.word_counts(_docs(s, d)), "word", 100),
        f"WITH {WORDS} SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY word DESC LIMIT 100",
    ),
    "word_count_sorted": (
        lambda s, d: counting.word_counts(_docs(s, d)).orderBy(F.desc("n"), "word"),
        f"WITH {WORDS} SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n DESC, word",
    ),
    "word_positions": (
        lambda s, d: skew.global_rank(counting.word_counts(_docs(s, d)), "word", "position"),
        f"WITH {WORDS} SELECT word, count(*) AS n, row_number() OVER (ORDER BY word) AS position FROM words GROUP BY word",
    ),
    "word_count_positions": (
        lambda s, d: skew.global_rank(counting.word_counts(_docs(s, d)), [F.desc("n"), "word"], "position"),
        f"WITH {WORDS} SELECT word, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, word) AS position FROM words GROUP BY word",
    ),
    "class_word_positions": (
        lambda s, d: skew.global_rank(counting.class_word_counts(labelled_documents(s, d), "quality"), ["class", F.desc("n"), "word"], "position"),
        f"WITH {LABELLED} SELECT word, quality AS class, count(*) AS n, row_number() OVER (ORDER BY quality, count(*) DESC, word) AS position FROM lw GROUP BY 1, 2",
    ),
    "mail_words": (
        lambda s, d: counting.word_counts(_mail_parts(s, d).select(join_text("subject", "content").alias("text"))),
        """WITH m AS (SELECT string_split(text, chr(10)) AS p FROM documents JOIN labels USING (doc_id)),
 j AS (SELECT concat_ws(' ', p[1], CASE WHEN len(p) > 1 THEN array_to_string(p[2:], chr(10)) END) AS text FROM m)
 SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM j) GROUP BY word""",
    ),
    "word_count_plural_folded": (
        lambda s, d: counting.fold_plurals(counting.word_counts(_docs(s, d))),
        f"""WITH {WORDS}, c AS (SELECT word, count(*) AS n, rtrim(word, 's') AS base, length(word) - length(rtrim(word, 's')) AS k FROM words GROUP BY word),
 r AS (SELECT *, k - row_number() OVER (PARTITION BY base ORDER BY k) AS run FROM c),
 p AS (SELECT *, row_number() OVER (PARTITION BY base, run ORDER BY k) AS pos FROM r)
 SELECT x.word, x.n + coalesce(y.n, 0) AS n FROM p x LEFT JOIN p y ON y.word = x.word || 's' WHERE x.pos % 2 = 1""",
    ),
    "class_word_count": (
        lambda s, d: counting.class_word_counts(labelled_documents(s, d), "quality"),
        f"WITH {LABELLED} SELECT word, quality AS class, count(*) AS n FROM lw GROUP BY 1, 2",
    ),
    "class_word_sorted": (
        lambda s, d: counting.sorted_by_group(counting.class_word_counts(labelled_documents(s, d), "quality"), "class", F.desc("n"), F.asc("word")),
        f"WITH {LABELLED} SELECT word, quality AS class, count(*) AS n FROM lw GROUP BY 1, 2 ORDER BY class, n DESC, word",
    ),
    "class_word_partitioned": (
        lambda s, d: counting.partitioned_by_group(counting.class_word_counts(labelled_documents(s, d), "quality"), "class", F.desc("n"), F.asc("word")),
        f"WITH {LABELLED} SELECT word, quality AS class, count(*) AS n FROM lw GROUP BY 1, 2",
    ),
    "class_word_pivot": (
        lambda s, d: counting.class_word_pivot(labelled_documents(s, d), "quality"),
        f"WITH {LABELLED} SELECT word, count(*) FILTER (quality = 0) AS c0, count(*) FILTER (quality = 1) AS c1 FROM lw GROUP BY word",
    ),
    "class_top_words": (
        lambda s, d: counting.top_words_per_class(counting.class_word_counts(labelled_documents(s, d), "quality")),
        f"""WITH {LABELLED}, c AS (SELECT word, quality AS class, count(*) AS n FROM lw GROUP BY 1, 2)
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY n DESC, word) AS rank FROM c) WHERE rank <= 10""",
    ),
    "corpus_totals": (
        lambda s, d: naive_bayes.corpus_totals(labelled_documents(s, d), "quality"),
        f"""WITH {LABELLED} SELECT count(*) FILTER (quality = 0) AS words0, count(*) FILTER (quality = 1) AS words1, count(DISTINCT word) AS vocabulary,
 (SELECT count(*) FROM labelled WHERE quality = 0) AS docs0, (SELECT count(*) FROM labelled WHERE quality = 1) AS docs1 FROM lw""",
    ),
    "ngram5_table": (lambda s, d: _grams(s, d, books=True), f"WITH {GRAMS} SELECT ngram, n, books FROM grams"),
    "ngram_word_weighted": (
        lambda s, d: ngrams.text_word_totals(_docs(s, d)),
        f"WITH {GRAMS}, {TOTALS} SELECT word, n FROM totals",
    ),
    "ngram_word_report": (
        lambda s, d: (lambda size, top, bottom: top.unionByName(bottom).withColumn("vocabulary", size.scalar()))(*ngrams.word_report(stored(ngrams.text_word_totals(_docs(s, d))), 10)),
        f"""WITH {GRAMS}, {TOTALS} SELECT word, n, (SELECT count(*) FROM totals) AS vocabulary FROM
 ((SELECT * FROM totals ORDER BY n DESC, word LIMIT 10) UNION ALL (SELECT * FROM totals ORDER BY n, word LIMIT 10))""",
    ),
    "ngram_neighbour_count": (
        _neighbours,
        f"WITH {GRAMS}, {NEIGHBOURS} SELECT word, neighbours FROM nb",
    ),
    "ngram_neighbour_report": (
        lambda s, d: (lambda top, bottom, _: top.unionByName(bottom))(*ngrams.neighbour_report(stored(_neighbours(s, d)), 10)),
        f"""WITH {GRAMS}, {NEIGHBOURS} (SELECT * FROM nb ORDER BY neighbours DESC, word LIMIT 10)
 UNION ALL (SELECT * FROM nb ORDER BY neighbours, word LIMIT 10)""",
    ),
    "ngram_neighbour_sample": (
        lambda s, d: ngrams.neighbour_report(_neighbours(s, d), 10)[2],
        f"WITH {GRAMS}, {NEIGHBOURS} SELECT word, neighbours FROM nb WHERE ('0x' || substr(md5('42|' || word), 1, 8))::BIGINT / 4294967296.0 < 0.01",
    ),
    "ranking_overlap": (
        _overlap,
        f"""WITH {GRAMS}, {TOTALS}, {NEIGHBOURS}, a AS (SELECT word FROM totals ORDER BY n DESC, word LIMIT 1000),
 b AS (SELECT word FROM nb ORDER BY neighbours DESC, word LIMIT 1000)
 SELECT count(*) AS size, count(b.word) AS common, round(100.0 * count(b.word) / count(*), 6)::DOUBLE AS percent FROM a LEFT JOIN b USING (word)""",
    ),
    "vocab_and_basis": (
        lambda s, d: _vocab(s, d).withColumn("in_basis", F.col("in_basis").cast("int")),
        f"WITH {GRAMS}, {TOTALS}, {VOCAB} SELECT word, n, rank, in_basis FROM vocab",
    ),
    "stop_words_removed": (
        lambda s, d: counting.word_counts(_docs(s, d)).where(~is_stop_word(F.col("word"))),
        f"WITH {WORDS} SELECT word, count(*) AS n FROM words WHERE word NOT IN ({_STOP}) GROUP BY word",
    ),
    "stripes": (
        lambda s, d: ngrams.stripes(_stripe_rows(s, d)).select("term", F.array_join("stripe", " ").alias("stripe")),
        f"{CHAIN} SELECT term, string_agg(feature, ' ' ORDER BY feature) AS stripe FROM sr GROUP BY term",
    ),
    "one_hot": (lambda s, d: ngrams.one_hot(_stripe_rows(s, d)), f"{CHAIN} SELECT term, feature, 1 AS value FROM sr"),
    "inverted_index": (
        lambda s, d: similarity.inverted_index(ngrams.stripes(_stripe_rows(s, d))),
        f"{CHAIN} SELECT feature, term, count(*) OVER (PARTITION BY term)::INT AS size FROM sr",
    ),
    "inverted_index_sizes": (
        lambda s, d: _stripe_rows(s, d).groupBy("feature").agg(F.count("*").alias("postings")),
        f"{CHAIN} SELECT feature, count(*) AS postings FROM sr GROUP BY feature",
    ),
    "shared_features": (
        lambda s, d: similarity.shared_feature_counts(ngrams.stripes(_stripe_rows(s, d)), N_TOTAL),
        f"{CHAIN}, {PAIRS} SELECT a, b, x.n AS n1, y.n AS n2, shared FROM sp JOIN sz x ON x.term = a JOIN sz y ON y.term = b",
    ),
    "term_similarity": (
        lambda s, d: _scored(similarity.term_similarities(ngrams.stripes(_stripe_rows(s, d)), N_TOTAL)),
        f"{CHAIN}, {PAIRS} SELECT {ROUNDED_PAIRS} FROM scored",
    ),
    "term_similarity_above": (
        lambda s, d: _scored(similarity.term_similarities(ngrams.stripes(_stripe_rows(s, d)), N_TOTAL, at_least=0.8)),
        f"{CHAIN}, {PAIRS} SELECT {ROUNDED_PAIRS} FROM scored WHERE scored.cosine >= 0.8 - 1e-9",
    ),
    "term_similarity_top": (
        lambda s, d: _scored(similarity.term_similarity_extremes(ngrams.stripes(_stripe_rows(s, d)), 100, N_TOTAL, "top")),
        f"{CHAIN}, {PAIRS} SELECT {ROUNDED_PAIRS} FROM scored ORDER BY round(scored.cosine, 9) DESC, a, b LIMIT 100",
    ),
    "term_similarity_bottom": (
        lambda s, d: _scored(similarity.term_similarity_extremes(ngrams.stripes(_stripe_rows(s, d)), 100, N_TOTAL, "bottom")),
        f"{CHAIN}, {PAIRS} SELECT {ROUNDED_PAIRS} FROM scored ORDER BY round(scored.cosine, 9), a, b LIMIT 100",
    ),
    "similarity_report": (
        _report,
        f"""{CHAIN}, {PAIRS} SELECT a || ' - ' || b AS pair, printf('%.4f', cosine) AS cosine, printf('%.4f', jaccard) AS jaccard,
 printf('%.4f', overlap) AS overlap, printf('%.4f', dice) AS dice FROM scored ORDER BY round(scored.cosine, 9) DESC, a, b LIMIT 20""",
    ),
    "ranking_common_words": (
        _common,
        f"""WITH {GRAMS}, {TOTALS}, {NEIGHBOURS} SELECT word, n FROM (SELECT word, n FROM totals ORDER BY n DESC, word LIMIT 1000)
 WHERE word IN (SELECT word FROM nb ORDER BY neighbours DESC, word LIMIT 1000)""",
    ),
    "doc_jaccard": (
        lambda s, d: _rounded(similarity.similar_sets(similarity.distinct_sets(_document_words(s, d)), JACCARD), 6, "jaccard"),
        f"""WITH {WORDS}, dw AS (SELECT DISTINCT doc_id, word FROM words), own AS (SELECT doc_id, list(word ORDER BY word) AS f FROM dw GROUP BY doc_id),
 st AS (SELECT f, min(doc_id) AS id, count(*) AS copies, len(any_value(f)) AS size FROM own GROUP BY f),
 sw AS (SELECT id, unnest(f) AS word FROM st),
 sh AS (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM sw x JOIN sw y ON x.word = y.word AND x.id < y.id GROUP BY 1, 2)
 SELECT a, b, x.copies AS copies_a, y.copies AS copies_b, shared, round(shared / (x.size + y.size - shared), 6) AS jaccard
 FROM sh JOIN st x ON x.id = a JOIN st y ON y.id = b WHERE shared / (x.size + y.size - shared) >= {JACCARD} - 1e-9""",
    ),
    "doc_copies": (
        lambda s, d: similarity.set_members(_document_words(s, d)),
        f"""WITH {WORDS}, dw AS (SELECT DISTINCT doc_id, word FROM words), own AS (SELECT doc_id, list(word ORDER BY word) AS f FROM dw GROUP BY doc_id)
 SELECT doc_id AS item, min(doc_id) OVER (PARTITION BY f) AS set_id FROM own""",
    ),
    "window_cooccurrence": (
        lambda s, d: ngrams.window_cooccurrence(_docs(s, d)),
        f"""WITH toks AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS t FROM documents),
 p AS (SELECT doc_id, unnest(t) AS w, unnest(range(len(t))) AS i FROM toks)
 SELECT x.w AS term, y.w AS feature, count(*) AS n FROM p x JOIN (SELECT doc_id, w, i, unnest([-2, -1, 1, 2]) AS k FROM p) y
 ON x.doc_id = y.doc_id AND x.i = y.i + y.k WHERE x.w <> y.w AND x.w NOT IN ({_STOP}) AND y.w NOT IN ({_STOP}) GROUP BY 1, 2""",
    ),
    "nb_train": (
        lambda s, d: _rounded(naive_bayes.train(labelled_documents(s, d), "quality"), 10, "p0", "p1"),
        f"""WITH {LABELLED}, c AS (SELECT word, count(*) FILTER (quality = 0) AS c0, count(*) FILTER (quality = 1) AS c1 FROM lw GROUP BY word)
 SELECT word, c0, c1, round(c0 / (SELECT sum(c0) FROM c), 10) AS p0, round(c1 / (SELECT sum(c1) FROM c), 10) AS p1 FROM c""",
    ),
    "nb_train_smoothed": (
        lambda s, d: _rounded(naive_bayes.train(labelled_documents(s, d), "quality", alpha=1.0), 10, "p0", "p1"),
        f"""WITH {LABELLED}, c AS (SELECT word, count(*) FILTER (quality = 0) AS c0, count(*) FILTER (quality = 1) AS c1 FROM lw GROUP BY word)
 SELECT word, c0, c1, round((c0 + 1) / ((SELECT sum(c0) FROM c) + (SELECT count(*) FROM c)), 10) AS p0,
 round((c1 + 1) / ((SELECT sum(c1) FROM c) + (SELECT count(*) FROM c)), 10) AS p1 FROM c""",
    ),
    "nb_priors": (
        lambda s, d: _rounded(naive_bayes.class_priors(labelled_documents(s, d), "quality"), 9, "prior0", "prior1"),
        f"""WITH {LABELLED} SELECT count(*) FILTER (quality = 0) AS docs0, count(*) FILTER (quality = 1) AS docs1,
 round(avg((quality = 0)::INT), 9) AS prior0, round(avg((quality = 1)::INT), 9) AS prior1 FROM labelled""",
    ),
    "nb_classify": (
        lambda s, d: _rounded(_scored_mail(s, d), 4, "lp0", "lp1"),
        _nb_sql("SELECT doc_id, quality, round(lp0, 4) AS lp0, round(lp1, 4) AS lp1, pred FROM p"),
    ),
    "nb_evaluate": (
        lambda s, d: _rounded(naive_bayes.evaluate(_scored_mail(s, d), "quality"), 6, "accuracy", "precision", "recall", "f_score"),
        _nb_sql(
            """, e AS (SELECT count(*) AS docs, count(*) FILTER (quality = 1 AND pred = 1) AS tp, count(*) FILTER (quality = 0 AND pred = 0) AS tn,
 count(*) FILTER (quality = 0 AND pred = 1) AS fp, count(*) FILTER (quality = 1 AND pred = 0) AS fn FROM p)
 SELECT docs, tp, tn, fp, fn, round((tp + tn) / docs, 6) AS accuracy, round(tp / nullif(tp + fp, 0), 6) AS precision,
 round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f_score FROM e"""
        ),
    ),
    "nb_top_words": (
        lambda s, d: _rounded(naive_bayes.top_words(naive_bayes.train(labelled_documents(s, d), "quality", alpha=1.0)), 10, "p"),
        f"""WITH {LABELLED}, c AS (SELECT word, count(*) FILTER (quality = 0) AS c0, count(*) FILTER (quality = 1) AS c1 FROM lw GROUP BY word),
 m AS (SELECT word, (c0 + 1) / ((SELECT sum(c0) FROM c) + (SELECT count(*) FROM c)) AS p0, (c1 + 1) / ((SELECT sum(c1) FROM c) + (SELECT count(*) FROM c)) AS p1 FROM c),
 b AS (SELECT word, CASE WHEN p0 >= p1 THEN 0 ELSE 1 END AS class, greatest(p0, p1) AS p FROM m)
 SELECT word, class, round(p, 10) AS p, rank FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY p DESC, word) AS rank FROM b) WHERE rank <= 10""",
    ),
}
