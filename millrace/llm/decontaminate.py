"""Benchmark passages in documents, by winnowed fingerprints.

A window is ``SPAN`` consecutive words of a benchmark item. Both sides hash
every run of ``GRAM`` words and keep, of every ``SPAN - GRAM + 1`` neighbouring
runs, the smallest hash. A shared span of ``SPAN`` words holds one such group
of neighbours whole, so both sides keep the same run of it: no shared span is
missed. Items shorter than a window are looked up as a whole.

1. Item fingerprints become a bitmap of bounded size; document fingerprints
   that are not in it are dropped where they are made. A full bitmap only
   lets more through.
2. The rest join the items' fingerprints by hash. Each carries the words
   around it, as far as a window can reach; the match is extended over equal
   words to both sides and counts if it spans a window.
3. Spans are united per document by a running maximum; equal contexts of
   several items are one row until a document has matched them.

Cases: null has no words; a text without words is not hit. Items that are
null, without words or without id take no part; rows of one item_id are one
item. Rows with equal doc_id and text have equal results, one row each; a
null doc_id is kept. An empty documents table gives no rows, an empty
benchmark leaves all documents clean. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.text import Words, batches, gram_hashes, mix, sliding
from millrace.session import stored

SPAN, GRAM = 10, 5
LARGEST_MAP = 1 << 27  # bits, 16 MB


def _key(hashes: np.ndarray, size: int) -> np.ndarray:
    return mix(hashes + np.uint64(size))


def _chosen(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of the winnowed runs."""
    grams = gram_hashes(hashes, GRAM) | np.uint64(1)
    lowest = sliding(grams, SPAN - GRAM + 1, np.minimum)
    lowest = np.where(words.same_text(SPAN)[: len(lowest)], lowest, np.uint64(0))
    if not len(lowest):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    edge = np.zeros(SPAN - GRAM, np.uint64)
    highest = sliding(np.concatenate([edge, lowest, edge]), SPAN - GRAM + 1, np.maximum)
    places = np.flatnonzero(highest == grams)
    return places, _key(grams[places], 0)


def _whole(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of all runs of ``size`` words."""
    grams = gram_hashes(hashes, size)
    places = np.flatnonzero(words.same_text(size)[: len(grams)])
    return places, _key(grams[places], size)


def _context(words: Words, text: int, place: int, size: int) -> tuple[bytes, bytes, bytes]:
    """Words before (nearest first), in and after a run."""
    reach = SPAN - GRAM if size == GRAM else 0
    low, high = max(words.first[text], place - reach), min(words.first[text + 1], place + size + reach)
    found = [words.data[a:b] for a, b in zip(words.start[low:high].tolist(), words.end[low:high].tolist())]
    at = place - low
    return b" ".join(found[:at][::-1]), b" ".join(found[at : at + size]), b" ".join(found[at + size :])


_CONTEXT = "size int, key bigint, before binary, inside binary, after binary"


def _item_contexts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for item, text in zip(frame["item_id"], frame["text"]):
            words = Words([text])
            n = len(words.start)
            if not n:
                continue
            size = GRAM if n >= SPAN else n
            # a whole short item of GRAM words must not pass for a run in a longer window
            kind = size if n >= SPAN else -size
            places, keys = _chosen(words, words.hashes()) if n >= SPAN else _whole(words, words.hashes(), size)
            for place, key in zip(places.tolist(), keys.view(np.int64).tolist()):
                before, inside, after = _context(words, 0, place, size) if kind > 0 else (b"", b" ".join(words.data.split()), b"")
                out.append((item, kind, key, before, inside, after))
        yield pd.DataFrame(out, columns=["item_id", "size", "key", "before", "inside", "after"])


def _bitmap(contexts: DataFrame) -> np.ndarray:
    """Bit per key, as a power of two of bits; at most ``LARGEST_MAP``."""
    n = contexts.select("key").distinct().count()
    bits = 1 << 16
    while bits < min(64 * n, LARGEST_MAP):
        bits *= 2
    place = F.col("key").bitwiseAND(bits - 1)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    words = contexts.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(one).alias("bits")).toPandas()
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def _scan(texts: Sequence[bytes | None], bitmap: np.ndarray, short: Sequence[int]) -> tuple[list[int], list[list[dict]]]:
    """Words and surviving fingerprints, with their context, of each text."""
    counts: list[int] = []
    hits: list[dict] = [{} for _ in texts]
    mask = np.uint64(len(bitmap) * 64 - 1)
    for first, run in batches(texts):
        words = Words(run)
        counts += np.diff(words.first).tolist()
        hashes = words.hashes()
        for size in [GRAM, *[-s for s in short]]:
            places, keys = _chosen(words, hashes) if size > 0 else _whole(words, hashes, -size)
            spot = keys & mask
            known = (bitmap[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
            for place, key in zip(places[known].tolist(), keys[known].view(np.int64).tolist()):
                text = int(words.text[place])
                if size > 0:
                    context = _context(words, text, place, GRAM)
                else:
                    context = b"", b" ".join(words.data[a:b] for a, b in zip(words.start[place : place - size], words.end[place : place - size])), b""
                hits[first + text].setdefault((size, key, *context), []).append(place - int(words.first[text]))
    names = ("size", "key", "before", "inside", "after")
    return counts, [[dict(zip(names, k)) | {"places": v} for k, v in h.items()] for h in hits]


def _common(a: bytes, b: bytes) -> int:
    """Equal words at the start of both."""
    n = 0
    for x, y in zip(a.split(), b.split()):
        if x != y:
            break
        n += 1
    return n


def _extend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for r in frame.itertuples(index=False):
            if r.inside != r.item_inside:
                continue
            left, right = _common(r.before, r.item_before), _common(r.after, r.item_after)
            size = abs(r.size)
            if r.size > 0 and left + size + right < SPAN:
                continue
            out.append((r.doc_id, r.text_hash, r.context, [p - left for p in r.places], left + size + right))
        yield pd.DataFrame(out, columns=["doc_id", "text_hash", "context", "starts", "length"])


def find(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_words, n_hit, item_ids`` (sorted strings) of
    every row of ``docs`` (``doc_id, text``) against ``items`` (``item_id,
    text``)."""
    wanted = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text"))
    ident = F.md5(F.concat_ws("|", F.col("size").cast("string"), F.hex("before"), F.hex("inside"), F.hex("after")))
    found = wanted.where("text IS NOT NULL").mapInPandas(_item_contexts, f"item_id string, {_CONTEXT}")
    found = stored(found.withColumn("context", ident))
    owners = found.select("item_id", "context").distinct()
    contexts = found.drop("item_id").distinct()
    short = sorted(-r["size"] for r in found.select("size").where("size < 0").distinct().collect())  # fewer than SPAN
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(found))

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts, hits = _scan(frame["text"].tolist(), bitmap.value, short)
            yield frame.drop(columns="text").assign(n_words=counts, hits=hits)

    rows = docs.select(
        F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text")
    )
    base = stored(rows.mapInPandas(scan, "doc_id string, text_hash bigint, n_words bigint, hits array<struct<size int, key bigint, before binary, inside binary, after binary, places array<int>>>"))
    keyed = base.where(F.size("hits") > 0).select("doc_id", "text_hash", F.inline("hits"))
    other = contexts.select("size", "key", "context", *[F.col(c).alias(f"item_{c}") for c in ("before", "inside", "after")])
    spans = stored(keyed.join(other, ["size", "key"]).mapInPandas(_extend, "doc_id string, text_hash bigint, context string, starts array<int>, length int"))

    doc = ["doc_id", "text_hash"]
    marks = spans.select(*doc, F.explode("starts").alias("low"), "length").select(*doc, "low", (F.col("low") + F.col("length")).alias("high")).distinct()
    earlier = Window.partitionBy(*doc).orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.col("low"), F.coalesce(F.max("high").over(earlier), F.lit(0)))
    covered = marks.withColumn("new", F.greatest(F.col("high") - reached, F.lit(0))).groupBy(*doc).agg(F.sum("new").alias("n_hit"))
    named = spans.select(*doc, "context").distinct().join(owners, "context").select(*doc, "item_id").distinct()
    listed = named.groupBy(*doc).agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    result = stored(covered.join(listed, covered["doc_id"].eqNullSafe(listed["doc_id"]) & (covered["text_hash"] == listed["text_hash"])).select(covered["doc_id"], covered["text_hash"], "n_hit", "item_ids"))

    same = base["doc_id"].eqNullSafe(result["doc_id"]) & (base["text_hash"].eqNullSafe(result["text_hash"]))
    return base.join(result, same, "left").select(
        base["doc_id"].cast("long").alias("doc_id"), base["text_hash"], "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no window of an item."""
    hit = find(docs, items).where("n_hit > 0").select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    whole = whole.withColumns({"id": F.col("doc.doc_id").cast("long"), "hash": F.xxhash64("doc.text")})
    return whole.join(hit, F.col("hit_id").eqNullSafe(F.col("id")) & (F.col("hit_hash") == F.col("hash")), "left_anti").select("doc.*")


_WORDS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
i_at AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM i_at),
d_at AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM windows)),
hits AS (SELECT doc_id, p, d_at.n, item_id FROM d_at JOIN windows ON d_at.n = windows.n AND array_to_string(w[p:p + d_at.n - 1], ' ') = g),
places AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places ON d.doc_id = places.doc_id LEFT JOIN named ON d.doc_id = named.doc_id
"""
