"""Ranked search against a plain sum over all documents and terms."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from texts import frame, odd_texts, sentence, words

from millrace.llm import ranking


def items(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "x", "y", 1, "z") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, "item_id bigint, text string, doc_id string, term string, slot int, score string").repartition(2)


def brute(docs, asked, k):
    """Per item row the ``(doc_id, score)`` list."""
    bags = [(i, words(t)) for i, t in docs]
    bags = [(i, Counter(b), len(b)) for i, b in bags if b]
    n, length = len(bags), sum(size for _, _, size in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item_id, text in asked:
        found = []
        for doc_id, bag, size in bags:
            m = 25 + (75 * size * n) // length
            score = 0
            for term in words(text):
                if bag[term]:
                    w = math.floor(1000 * math.log((2.0 * n + 2) / (2 * df[term] + 1)))
                    score += w * ((1_000_000_000 * bag[term]) // (1000 * bag[term] + 8 * m))
            if score > 0:
                found.append((-score, (doc_id is not None, doc_id or 0), doc_id))
        out += [(item_id, r, d, -s) for r, (s, _, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def collection():
    rng = random.Random(5)
    texts = odd_texts() + [sentence(rng, rng.randint(1, 60)) for _ in range(150)] + ["Tie word"] * 30
    asked = [None, "", "!?", "tie", "TIE word tie", "absent everywhere", "größe é" * 3, sentence(rng, 200), *[sentence(rng, 9) for _ in range(8)]]
    texts += [asked[7] + " and more", "größe"]
    return texts, asked


@pytest.mark.parametrize("shard, bundle, owners, k", [(8192, 256, ranking.OWNERS, 10), (4, 2, (0.02, 0.1, 0.3), 3), (7, 4, (), 5), (16, 1, (0.05, 0.9), 1)])
def test_search(spark, monkeypatch, shard, bundle, owners, k):
    monkeypatch.setattr(ranking, "SHARD_DOCS", shard)
    monkeypatch.setattr(ranking, "BUNDLE", bundle)
    monkeypatch.setattr(ranking, "OWNERS", owners)
    texts, asked = collection()
    ids = [None, 5, *range(2, len(texts))]
    got = ranking.search(frame(spark, texts, ids), items(spark, asked), k)
    assert sorted(map(tuple, got.collect()), key=str) == brute([*zip(ids, texts)], [*enumerate(asked)], k)


def test_full_bitmap(spark, monkeypatch):
    monkeypatch.setattr(ranking, "LARGEST_MAP", 64)  # never below the least size; lets other terms through
    monkeypatch.setattr(ranking, "_bitmap", lambda terms: ranking.np.full(1024, 0xFFFFFFFFFFFFFFFF, ranking.np.uint64))
    texts, asked = collection()
    got = ranking.search(frame(spark, texts), items(spark, asked))
    assert sorted(map(tuple, got.collect()), key=str) == brute([*enumerate(texts)], [*enumerate(asked)], 10)


def test_repeated_rows(spark):
    got = ranking.search(frame(spark, ["alpha beta"] * 3 + ["gamma"], [1, 1, None, 2]), items(spark, ["alpha", "alpha"], [9, 9])).collect()
    assert sorted((r.item_id, r.rank, str(r.doc_id)) for r in got) == sorted([(9, 1, "None"), (9, 2, "1"), (9, 3, "1")] * 2)


def test_none(spark):
    some, none = frame(spark, ["alpha"]), frame(spark, [])
    for docs, asked in ((some, []), (none, ["alpha"]), (none, []), (frame(spark, [None, "", "?"]), ["alpha"]), (some, [None, "beta"])):
        found = ranking.search(docs, items(spark, asked) if asked else items(spark, ["x"]).where(F.lit(False)))
        assert found.collect() == [] and found.columns == ["item_id", "rank", "doc_id", "score"]
