import itertools
import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from results import rows
from millrace.functions.text import STOP_WORDS, ngrams as ngram_col, words
from millrace.operators import counting, grams as packed, naive_bayes, ngrams, pairs, similarity, skew

# Toy inputs with known answers.
NOTE = ["This is a small test file. This file is for a test.", "This small test file has two small lines."]
AGE = {
    "it was the best of": 1, "age of wisdom it was": 1, "best of times it was": 1, "it was the age of": 2, "it was the worst of": 1,
    "of times it was the": 2, "of wisdom it was the": 1, "the age of wisdom it": 1, "the best of times it": 1, "the worst of times it": 1,
    "times it was the age": 1, "times it was the worst": 1, "was the age of wisdom": 1, "was the best of times": 1,
    "was the age of foolishness": 1, "was the worst of times": 1, "wisdom it was the age": 1, "worst of times it was": 1,
}
MAIL = [
    ("d1", 1, "Chinese Beijing Chinese", True), ("d2", 1, "Chinese Chinese Shanghai", True), ("d3", 1, "Chinese Macao", True),
    ("d4", 0, "Tokyo Japan Chinese", True), ("d5", 1, "Chinese Chinese Chinese Tokyo Japan", False), ("d6", 1, "Beijing Shanghai Trade", False),
    ("d7", 0, "Japan Macao Tokyo", False), ("d8", 0, "Tokyo Japan Trade", False),
]


@pytest.fixture(scope="module")
def grams(spark):
    return spark.createDataFrame([(g, n, n, n) for g, n in AGE.items()], "ngram string, n long, pages long, books long").cache()


@pytest.fixture(scope="module")
def mail(spark):
    return spark.createDataFrame(MAIL, "id string, spam int, text string, train boolean").cache()


def test_tokeniser(spark):
    df = spark.createDataFrame([("By-the-bye, what became of Alice's 12 hats?!",)], "t string")
    assert df.select(words("t")).first()[0] == "by the bye what became of alice s hats".split()
    assert df.select(words("t", lower=False)).first()[0][0] == "By"
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 136


def test_word_count_and_merge(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(NOTE)], "id int, text string")
    want = {("this", 3), ("test", 3), ("small", 3), ("file", 3), ("is", 2), ("a", 2), ("for", 1), ("has", 1), ("two", 1), ("lines", 1)}
    assert rows(counting.word_counts(docs)) == want
    assert rows(counting.merge_counts(counting.word_counts(docs, by=["id"]).drop("id"))) == want
    assert [r.word for r in counting.top_n(counting.word_counts(docs), "n", 2, "word").collect()] == ["file", "small"]


def test_plural_folding(spark):
    counts = spark.createDataFrame([("cat", 2), ("cats", 3), ("dogs", 1), ("a", 1), ("as", 2), ("ass", 4), ("s", 1)], "word string, n long")
    assert rows(counting.fold_plurals(counts)) == {("cat", 5), ("dogs", 1), ("a", 3), ("ass", 4), ("s", 1)}


def test_class_counts(spark):
    docs = spark.createDataFrame([("one", 1), ("one two", 0), ("one", 0)], "text string, k int")
    assert rows(counting.class_word_counts(docs, "k")) == {("one", 1, 1), ("one", 0, 2), ("two", 0, 1)}
    assert rows(counting.class_word_pivot(docs, "k")) == {("one", 2, 1), ("two", 1, 0)}


def test_group_order_spreads(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("int").alias("g"), F.col("id").alias("n"))
    placed = counting.partitioned_by_group(df, "g", F.desc("n"), parts=8)
    parts = placed.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) > 2 and sum(r["count"] for r in parts) == 1000


def test_ngram_goldens(grams):
    totals = {("was", 17), ("of", 17), ("the", 17), ("it", 16), ("times", 10), ("age", 8), ("worst", 5), ("wisdom", 5), ("best", 4), ("foolishness", 1)}
    assert rows(ngrams.ngram_word_totals(grams)) == totals
    assert rows(ngrams.neighbour_counts(ngrams.neighbour_pairs(grams))) == {
        ("was", 9), ("of", 9), ("the", 9), ("it", 8), ("age", 7), ("times", 7), ("best", 5), ("worst", 5), ("wisdom", 5), ("foolishness", 4)
    }
    size, top, bottom = ngrams.word_report(ngrams.ngram_word_totals(grams), 2)
    assert size.first()[0] == 10 and [r.word for r in top.collect()] == ["of", "the"] and bottom.first().word == "foolishness"


def test_stripes_and_similarity_goldens(grams):
    vocab = ngrams.vocab_and_basis(ngrams.ngram_word_totals(grams), 10, 10)
    stripe_rows = ngrams.stripe_rows(ngrams.neighbour_pairs(grams), vocab)
    stripes = ngrams.stripes(stripe_rows).cache()
    assert {r.term: set(r.stripe) for r in stripes.collect()} == {
        "worst": {"times"}, "best": {"times"}, "foolishness": {"age"}, "times": {"age", "best", "worst"},
        "age": {"wisdom", "foolishness", "times"}, "wisdom": {"age"},
    }
    assert ngrams.one_hot(stripe_rows).count() == 10
    wide = ngrams.one_hot_wide(stripe_rows, ["age", "times"])
    assert {(r.term, r.age, r.times) for r in wide.collect()} >= {("best", 0, 1), ("wisdom", 1, 0)}
    got = {(r.a, r.b): tuple(round(x, 6) for x in r[2:]) for r in similarity.term_similarities(stripes, 10, block=3).collect()}
    third = (0.57735, 0.333333, 1.0, 0.5)
    assert got == {
        ("best", "worst"): (1, 1, 1, 1), ("foolishness", "wisdom"): (1, 1, 1, 1), ("age", "best"): third, ("age", "worst"): third,
        ("foolishness", "times"): third, ("times", "wisdom"): third,
    }
    top = similarity.term_similarity_extremes(stripes, 3, 10, "top", block=2).collect()
    assert [(r.a, r.b) for r in top] == [("best", "worst"), ("foolishness", "wisdom"), ("age", "best")]
    bottom = similarity.term_similarity_extremes(stripes, 2, 10, "bottom", block=2).collect()
    assert [(r.a, r.b) for r in bottom] == [("age", "best"), ("age", "worst")]


def test_vocab_rank_slice(spark):
    grams = spark.createDataFrame([(w, n) for w, n in [("alpha", 5), ("beta", 4), ("the", 99), ("gamma", 3), ("delta", 1)]], "ngram string, n long")
    got = ngrams.vocab_and_basis(ngrams.ngram_word_totals(grams), 3, 1).orderBy("rank").collect()
    assert [(r.word, r.in_basis) for r in got] == [("alpha", False), ("beta", False), ("gamma", True)]


def test_ngram_table(spark):
    docs = spark.createDataFrame([(1, "a b c a b c"), (2, "a b c"), (3, "a b")], "doc_id int, text string")
    assert rows(ngrams.ngram_table(docs, n=3)) == {("a b c", 3, 2), ("b c a", 1, 1), ("c a b", 1, 1)}
    assert rows(ngrams.ngram_table(docs, n=3, books=False)) == {("a b c", 3), ("b c a", 1), ("c a b", 1)}


def test_window_cooccurrence(spark):
    text = "It was the best of times, it was the worst of times, \nit was the age of wisdom it was the age of foolishness"
    docs = spark.createDataFrame([(text,)], "text string")
    got = defaultdict(set)
    for r in ngrams.window_cooccurrence(docs, stop_words=["it", "the", "was", "of"]).collect():
        got[r.term].add(r.feature)
    assert got == {
        "age": {"wisdom", "foolishness"}, "best": {"times"}, "foolishness": {"age"}, "times": {"best", "worst"}, "wisdom": {"age"}, "worst": {"times"}
    }


def test_ranking_overlap(spark):
    a = spark.createDataFrame([("x",), ("y",), ("z",), ("w",)], "word string")
    b = spark.createDataFrame([("y",), ("z",), ("q",)], "word string")
    assert counting.ranking_overlap(a, b).first()["percent"] == 50.0


def test_document_jaccard_goldens(spark):
    docs = {"A": "bright blue butterfly forget", "B": "best forget bright sky", "C": "blue sky bright sun", "D": "under butterfly sky hangs", "E": "forget blue butterfly"}
    feats = spark.createDataFrame([(k, w) for k, t in docs.items() for w in t.split()], "doc string, word string")
    sets = similarity.distinct_sets(similarity.owned_features(feats, "doc", "word"))
    got = {r.a + r.b: round(r.jaccard, 6) for r in similarity.similar_sets(sets, 0.01).collect()}
    want = {"AE": 0.75, "AB": 0.333333, "AC": 0.333333, "BC": 0.333333, "BE": 0.166667, "CE": 0.166667, "DE": 0.166667, "AD": 0.142857, "BD": 0.142857, "CD": 0.142857}
    assert got == want


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.8, 1.0])
def test_similar_sets_match_brute_force(spark, threshold, monkeypatch):
    """Random sets with a feature in every set and a third of equal sets."""
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 20)
    monkeypatch.setattr(skew, "SAMPLE", 1)
    rng = random.Random(7)
    sets = {i: frozenset(["all"] + ([f"x{j}" for j in range(5)] if i % 3 == 0 else [f"w{rng.randrange(25)}" for _ in range(rng.randrange(1, 9))])) for i in range(150)}
    feats = spark.createDataFrame([(i, w) for i, s in sets.items() for w in s], "item int, word string")
    owned = similarity.owned_features(feats, "item", "word").cache()
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    copies = Counter(sets.values())
    want = set()
    for (s, a), (t, b) in itertools.combinations(sorted(first.items(), key=lambda x: x[1]), 2):
        score = len(s & t) / len(s | t)
        if score >= threshold - 1e-9:
            want.add((a, b, copies[s], copies[t], len(s & t), round(score, 9)))
    got = {(*r[:5], round(r.jaccard, 9)) for r in similarity.similar_sets(similarity.distinct_sets(owned), threshold).collect()}
    assert got == want
    assert rows(similarity.set_members(owned)) == {(i, first[s]) for i, s in sets.items()}


def test_signatures_keep_unlike_sets_apart(spark, monkeypatch):
    rng, stored, seen = random.Random(5), similarity.stored, []
    monkeypatch.setattr(similarity, "stored", lambda df: seen.append(stored(df)) or seen[-1])
    sets = [rng.sample(range(200), 39) + [1000 + i // 2] for i in range(60)]
    sets += [sets[0][:38] + [3000, 3001]]
    rows = spark.createDataFrame([(i, f"f{f}") for i, s in enumerate(sets) for f in s], "item long, feature string")
    found = similarity.similar_sets(similarity.distinct_sets(similarity.owned_features(rows, "item", "feature")), 0.8)
    assert [(r.a, r.b, r.shared) for r in found.collect()] == [(0, 60, 38)]
    assert seen[-1].columns == ["a", "b"] and seen[-1].count() == 1


def test_repeated_set_ids_keep_their_links(spark):
    sets = [[f"f{i}" for i in range(at, at + 40)] for at in (0, 1)]
    owned = spark.createDataFrame([(0, sets[0]), (0, sets[0]), (1, sets[1])], "item long, features array<string>")
    found = similarity.similar_sets(similarity.distinct_sets(owned), 0.8)
    assert {(r.a, r.b, r.shared) for r in found.collect()} == {(0, 1, 39)}


def test_sets_travel_once_per_cell(spark, monkeypatch):
    """Sixty sets that are all alike make 1,770 pairs; each set is sent once."""
    alike = [[f"f{j}" for j in range(60)] + [f"own{i}"] for i in range(60)]
    owned = spark.createDataFrame(list(enumerate(alike)), "item long, features array<string>")
    keep = similarity._counter

    def counter():
        count = keep()
        return lambda sets, pairs: (out := count(sets, pairs)).set_column(6, "shared", pa.array([sets.num_rows] * out.num_rows, pa.int64()))

    monkeypatch.setattr(similarity, "_counter", counter)
    found = similarity.similar_sets(similarity.distinct_sets(owned), 0.8).collect()
    assert len(found) == 1770 and {r.shared for r in found} == {60}


def test_cells_are_cut_by_sets_and_pairs(spark, monkeypatch):
    """A crowd on a grid of cells and a set id that two rows have, against brute force."""
    rng = random.Random(9)
    sets = [frozenset(range(30)) - {rng.randrange(30), rng.randrange(30)} | {100 + rng.randrange(4)} for _ in range(40)]
    sets += [frozenset(range(200 + 5 * i, 215 + 5 * i)) for i in range(8)]
    rows = [(f"s{i:02d}", len(s), 1 + i, [f"f{x}" for x in sorted(s)]) for i, s in enumerate(dict.fromkeys(sets))]
    rows.append(rows[3])
    sizes = spark.createDataFrame(rows, "set_id string, size int, copies long, features array<string>")
    want = Counter()
    for x, y in itertools.combinations(rows, 2):
        a, b = sorted((x, y))
        n = len({*a[3]} & {*b[3]})
        if a[0] != b[0] and n / (a[1] + b[1] - n) >= 0.5 - 1e-9:
            want[a[0], b[0], a[2], b[2], n] += 1
    for cell, work in ((1 << 23, 1 << 29), (200, 1 << 29), (1 << 23, 3000)):
        monkeypatch.setattr(similarity, "CELL", cell)
        monkeypatch.setattr(similarity, "WORK", work)
        assert Counter(tuple(r[:5]) for r in similarity.similar_sets(sizes, 0.5).collect()) == want


def test_block_products_match_brute_force(spark):
    rng = random.Random(3)
    sets = {f"t{i:03d}": {f"f{rng.randrange(30)}" for _ in range(rng.randrange(1, 10))} for i in range(120)}
    stripes = spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()], "term string, stripe array<string>")
    want = {(a, b, len(sets[a]), len(sets[b]), len(sets[a] & sets[b])) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] & sets[b]}
    assert rows(similarity.shared_feature_counts(stripes, 120, block=17)) == want
    scored = similarity.term_similarities(stripes, 120, block=50).collect()
    for bound in (0.3, 0.5, 1.0):
        above = similarity.term_similarities(stripes, 120, block=50, at_least=bound)
        assert rows(above.select("a", "b")) == {(r.a, r.b) for r in scored if r.cosine >= bound - 1e-9}
    for r in scored:
        assert r.jaccard <= r.dice + 1e-12 and r.dice <= r.cosine + 1e-12 and r.cosine <= r.overlap + 1e-12
    for which, sign in (("top", -1), ("bottom", 1)):
        order = sorted(scored, key=lambda r: (sign * round(r.cosine, 9), r.a, r.b))[:15]
        got = similarity.term_similarity_extremes(stripes, 15, 120, which, block=17).collect()
        assert [(r.a, r.b) for r in got] == [(r.a, r.b) for r in order]


def test_naive_bayes_goldens(mail):
    train = mail.where("train")
    smoothed = {r.word: (r.c0, r.c1, r.p0, r.p1) for r in naive_bayes.train(train, "spam", alpha=1.0).collect()}
    assert smoothed["chinese"] == (1, 5, pytest.approx(2 / 9), pytest.approx(6 / 14))
    assert smoothed["tokyo"] == (1, 0, pytest.approx(2 / 9), pytest.approx(1 / 14))
    assert smoothed["beijing"] == (0, 1, pytest.approx(1 / 9), pytest.approx(2 / 14))
    assert len(smoothed) == 6
    plain = {r.word: (r.p0, r.p1) for r in naive_bayes.train(train, "spam").collect()}
    assert plain["chinese"] == (pytest.approx(1 / 3), pytest.approx(5 / 8)) and plain["beijing"] == (0, pytest.approx(1 / 8))
    assert tuple(naive_bayes.class_priors(train, "spam").first()) == (1, 3, 0.25, 0.75)
    assert tuple(naive_bayes.corpus_totals(train, "spam").first()) == (3, 8, 6, 1, 3)


def test_naive_bayes_scores(mail):
    train = mail.where("train")
    model, priors = naive_bayes.train(train, "spam", alpha=1.0), naive_bayes.class_priors(train, "spam")
    got = {r.id: (r.lp0, r.lp1, r.pred) for r in naive_bayes.classify(mail.where("NOT train"), model, priors, "id", "spam").collect()}
    want = {"d5": (-8.90668134, -8.10769031, 1), "d6": (-5.78074351, -4.17950237, 1), "d7": (-6.59167373, -7.51170688, 0), "d8": (-4.39444915, -5.56579673, 0)}
    for k, (a, b, p) in want.items():
        assert got[k] == (pytest.approx(a, abs=1e-7), pytest.approx(b, abs=1e-7), p)


def test_naive_bayes_zero_probabilities_and_empty_text(mail, spark):
    train = mail.where("train")
    model, priors = naive_bayes.train(train, "spam"), naive_bayes.class_priors(train, "spam")
    docs = spark.createDataFrame([("e", 0, ""), ("z", 1, "beijing tokyo"), ("u", 1, "nowhere")], "id string, spam int, text string")
    got = {r.id: r for r in naive_bayes.classify(docs, model, priors, "id", "spam").collect()}
    assert got["e"].lp0 == pytest.approx(math.log(0.25)) and got["u"].lp1 == pytest.approx(math.log(0.75))
    assert got["z"].lp0 == got["z"].lp1 == float("-inf") and got["z"].pred == 0


def test_evaluation_goldens(spark):
    def check(tp, tn, fp, fn):
        data = [(1, 1)] * tp + [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn
        return naive_bayes.evaluate(spark.createDataFrame(data, "y int, pred int"), "y").first()

    r = check(11, 6, 3, 0)
    assert (r.accuracy, round(r.precision, 6), r.recall, r.f_score) == (0.85, 0.785714, 1.0, 0.88)
    r = check(1, 9, 0, 10)
    assert (r.accuracy, r.precision, round(r.recall, 6), round(r.f_score, 6)) == (0.5, 1.0, 0.090909, 0.166667)
    assert check(0, 3, 0, 0).precision is None


def test_plans_stay_in_the_jvm(spark, mail):
    """No Python stage and no Cartesian product in the counting jobs."""
    for df in (
        counting.word_counts(mail), counting.top_words_per_class(counting.class_word_counts(mail, "spam")),
        ngrams.neighbour_counts(ngrams.text_neighbour_pairs(mail, n=2)), naive_bayes.train(mail, "spam", alpha=1.0), ngrams.window_cooccurrence(mail),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    top = counting.top_words_per_class(counting.class_word_counts(mail, "spam"))
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_ngram_column(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a"],), ([],)], "t array<string>")
    assert [r[0] for r in df.select(ngram_col(F.col("t"), 2)).collect()] == [["a b"], None, None]


@pytest.mark.parametrize("n", [2, 5])
def test_texts_give_what_their_ngrams_give(spark, n):
    """Totals, neighbours and stripes with and without the n-gram table."""
    rng = random.Random(n)
    texts = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 2) for _ in range(rng.randint(0, 14))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "doc_id int, text string")
    grams = ngrams.ngram_table(docs, n=n)
    assert rows(ngrams.text_word_totals(docs, n=n)) == rows(ngrams.ngram_word_totals(grams))
    assert rows(ngrams.text_neighbour_pairs(docs, n=n)) == rows(ngrams.neighbour_pairs(grams))
    vocab = ngrams.vocab_and_basis(ngrams.text_word_totals(docs, n=n), 12, 5).cache()
    assert rows(ngrams.text_stripe_rows(docs, vocab, n=n)) == rows(ngrams.stripe_rows(ngrams.neighbour_pairs(grams), vocab))


NEAR = [
    "a b c d e f a b", "the the the the the the", "a b", "", None, "B c x, y z. c x q r s t u v w" * 3, "a b c d e f a b", "K İx straße zz\n\taa",
    "abcdefghijkl abcdefghijklm abcdefghijklmn of the abcdefghijklm abcdefghijkl a zzzzzzzzzzzz zzzzzzzzzzzzz", "zz", "Incomprehensibilities of a word",
]


@pytest.mark.parametrize("run", [3, 1 << 21])
@pytest.mark.parametrize("n", [2, 5])
def test_neighbours_are_counted_as_numbers(spark, monkeypatch, n, run):
    """Counts from numbers of words equal those from the pairs of words, over
    runs that end inside texts, texts that meet without a gap and long words;
    pairs do not travel as strings."""
    docs = spark.createDataFrame(list(enumerate(NEAR)), "doc_id long, text string")
    want = rows(ngrams.neighbour_counts(ngrams.text_neighbour_pairs(docs, n=n)))
    monkeypatch.setattr(pairs, "RUN", run)
    monkeypatch.setattr(pairs, "SLICE", 8 * run)
    for spread in (1, 4):
        found = ngrams.text_neighbour_counts(docs.coalesce(1).repartition(spread), n=n)
        assert rows(found) == want
    assert "arrays_zip" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("size", [16, 1 << 23])
@pytest.mark.parametrize("n", [1, 2, 5])
def test_ngrams_are_moved_packed(spark, monkeypatch, n, size):
    """Counts by text and document, where ids repeat, are missing or meet in
    one slice or several; no n-gram travels as a row of its own."""
    ids = [1, 2, None, 4, 5, 6, 1, None, 2, 7, 8]
    texts = list(zip(ids, NEAR)) + [(100 + i, "so it was the age of it was the age of") for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    count, books = Counter(), defaultdict(set)
    for r in docs.select("doc_id", words("text").alias("t")).where("t IS NOT NULL").collect():
        for i in range(len(r.t) - n + 1):
            gram = " ".join(r.t[i : i + n])
            count[gram] += 1
            books[gram].add(r.doc_id)
    monkeypatch.setattr(packed, "SLICE", size)
    monkeypatch.setattr(packed, "PART", 64)
    for spread in (1, 4):
        found = ngrams.ngram_table(docs.coalesce(1).repartition(spread), n=n)
        assert sorted(tuple(r) for r in found.collect()) == sorted((g, c, len(books[g])) for g, c in count.items())
    assert "array_join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert ngrams.ngram_table(docs.limit(0), n=n).count() == 0


@pytest.mark.parametrize("run", [3, 1 << 21])
def test_cooccurrences_are_counted_as_numbers(spark, monkeypatch, run):
    """The same counts as by document, added up; stop words of any length."""
    docs = spark.createDataFrame(list(enumerate(NEAR)), "doc_id long, text string")
    monkeypatch.setattr(pairs, "RUN", run)
    monkeypatch.setattr(pairs, "SLICE", 8 * run)
    for stop_words in (None, [], ["the", "it's", "a", "abcdefghijklm", "É", ""]):
        apart = ngrams.window_cooccurrence(docs, "doc_id", reach=3, stop_words=stop_words)
        want = rows(apart.groupBy("term", "feature").agg(F.sum("n").alias("n")))
        found = ngrams.window_cooccurrence(docs.coalesce(1), reach=3, stop_words=stop_words)
        assert rows(found) == want and found.dtypes == [("term", "string"), ("feature", "string"), ("n", "bigint")]
    assert "arrays_zip" not in found._jdf.queryExecution().optimizedPlan().toString()
