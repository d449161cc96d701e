"""Ranked lexical search: the best documents for each query item.

Query evaluation over term owners in a pipeline. The vocabulary is divided
among ``OWNERS`` by how many documents hold a term, the rarest first; an
owner's posting lists are cut into shards of consecutive documents. Items
travel in bundles. For every shard, a bundle carries one sparse accumulator
(document, score) per item from owner to owner: each stage cogroups the
bundles with the owner's lists, adds the owner's integer contributions and
sends the bundles on. The last owner's stage selects.

1. Documents are cut into words where they are read. A bitmap of item terms,
   of at most ``LARGEST_MAP`` bits, lets through what may be asked for; a full
   bitmap lets more through and changes no result. Each shard gives one posting row
   per term, and a row with its documents and their lengths.
2. Posting rows meet the items' terms in an equi-join on the term itself,
   which also says which items of a bundle use the list.
3. After each stage but the last, an item's ``k``-th best score so far is a
   floor. A document goes on only if its score and the most that later owners
   can add reach the floor, so nothing that could be among the ``k`` best is
   dropped. What may be added is at most weight x 1,000,000 for each use of a
   term. A document that was left out comes back with less than the floor and
   is left out again.
4. Each shard gives its ``k`` best for each item; the best of these are the
   result.

A shard has at most ``SHARD_DOCS`` documents and a bundle at most ``BUNDLE``
items, so a task's work has a bound that no term's frequency changes.

Cases: null or empty text has no terms: as a document it is never found and
does not count, as an item it finds nothing. Every row is a document, and an
item, of its own, repeated rows and null ids too (a null doc_id comes first
among equal scores). No rows on either side give no rows. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.text import Words, batches
from millrace.session import stored

# Greatest share of all documents that hold a term of the owner; the last owner has the rest.
OWNERS = (1 / 1000, 1 / 50, 1 / 8)
SHARD_DOCS = 8192
SHARD_WORDS = 1 << 22
BUNDLE = 256  # items, a power of two
ITEMS_A_PART = 1 << 16
LARGEST_MAP = 1 << 27  # bits
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = r"[0-9a-z\x{80}-\x{10FFFF}]+"
_IMPACT = 1_000_000  # no contribution to a score reaches weight times this

_INDEX = "shard bigint, term binary, n_docs bigint, docs binary, tfs binary, doc_ids array<bigint>, sizes array<bigint>"
_INDEX_SCHEMA = pa.schema([
    ("shard", pa.int64()), ("term", pa.binary()), ("n_docs", pa.int64()), ("docs", pa.binary()), ("tfs", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
])


def item_terms(items: DataFrame) -> DataFrame:
    """``bundle, slot, term, q`` (uses of the term) of ``items`` that hold
    ``bundle, slot, text``."""
    found = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(f"({_TERM})"), F.lit(1))
    words = items.select("bundle", "slot", F.explode(found).alias("term"))
    return words.groupBy("bundle", "slot", F.col("term").cast("binary").alias("term")).agg(F.count("*").alias("q"))


def _bitmap(terms: DataFrame) -> np.ndarray:
    """Bit per term hash, as a power of two of bits; at most ``LARGEST_MAP``."""
    n = terms.count()
    bits = 1 << 16
    while bits < min(64 * n, LARGEST_MAP):
        bits *= 2
    place = F.xxhash64("term").bitwiseAND(bits - 1)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    words = terms.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(one).alias("bits")).toPandas()
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


class _Shard:
    """Postings of consecutive documents."""

    def __init__(self, number: int):
        self.number = number
        self.terms: dict[bytes, int] = {}
        self.doc_ids: list = []
        self.sizes: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.words = 0

    def add(self, doc_ids: list, texts: list[bytes], bitmap: np.ndarray) -> None:
        words = Words(texts)
        size = words.end - words.start
        codes = np.frombuffer(words.data, np.uint8)
        letters = codes[codes != 0x20]
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        every = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        mask, numbers = len(bitmap) * 64 - 1, np.full(len(every.dictionary), -1, np.int64)
        spots = np.fromiter((xxhash.xxh64_intdigest(t, 42) & mask for t in every.dictionary.to_pylist()), np.int64, len(numbers))
        may = bitmap[spots >> 6] >> (spots & 63).astype(np.uint64) & np.uint64(1) == 1
        for code in np.flatnonzero(may).tolist():
            numbers[code] = self.terms.setdefault(every.dictionary[code].as_py(), len(self.terms))
        number = numbers[every.indices.to_numpy()]
        wanted = number >= 0
        pairs, tfs = np.unique(number[wanted] << 32 | words.text[wanted] + len(self.doc_ids), return_counts=True)
        self.parts.append((pairs >> 32, (pairs & 0xFFFFFFFF).astype("<u2"), tfs.astype("<u4")))
        self.doc_ids += doc_ids
        self.sizes.append(np.diff(words.first))
        self.words += len(size)

    def rows(self) -> pa.RecordBatch:
        number, docs, tfs = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(number, kind="stable")
        docs, tfs = docs[order], tfs[order]
        counts = np.bincount(number, minlength=len(self.terms))
        stops = np.cumsum(counts)
        n = len(counts) + 1
        spans = list(zip((stops - counts).tolist(), stops.tolist()))
        columns = {
            "shard": [self.number] * n,
            "term": [*self.terms, None],
            "n_docs": [*counts.tolist(), int(sum((s > 0).sum() for s in self.sizes))],
            "docs": [*(docs[a:b].tobytes() for a, b in spans), None],
            "tfs": [*(tfs[a:b].tobytes() for a, b in spans), None],
            "doc_ids": [None] * (n - 1) + [self.doc_ids],
            "sizes": [None] * (n - 1) + [np.concatenate(self.sizes)],
        }
        return pa.record_batch([pa.array(columns[f.name], f.type) for f in _INDEX_SCHEMA], schema=_INDEX_SCHEMA)


def index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Posting rows of the documents for ``terms`` (and some others): ``shard,
    term, n_docs, docs, tfs``; per shard a row without term holds ``doc_ids``,
    ``sizes`` in words and, as ``n_docs``, the documents with any word."""
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(terms))

    def build(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = TaskContext.get().partitionId() << 33
        shard = _Shard(seq)
        for batch in found:
            doc_ids = batch.column("doc_id").to_pylist()
            for first, texts in batches(batch.column("text").to_pylist()):
                for at in range(0, len(texts), SHARD_DOCS):
                    some = texts[at : at + SHARD_DOCS]
                    if shard.doc_ids and (len(shard.doc_ids) + len(some) > SHARD_DOCS or shard.words > SHARD_WORDS):
                        yield shard.rows()
                        seq += 1
                        shard = _Shard(seq)
                    start = first + at
                    shard.add(doc_ids[start : start + len(some)], some, bitmap.value)
        if shard.doc_ids:
            yield shard.rows()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return stored(rows.mapInArrow(build, _INDEX))


_STATE = (
    "bundle bigint, shard bigint, slots array<int>, rests array<bigint>, doc_ids array<bigint>, sizes array<bigint>, "
    "held array<int>, docs binary, scores binary, best array<struct<slot: int, score: bigint>>"
)
_STATE_SCHEMA = pa.schema([
    ("bundle", pa.int64()), ("shard", pa.int64()), ("slots", pa.list_(pa.int32())), ("rests", pa.list_(pa.int64())),
    ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("held", pa.list_(pa.int32())), ("docs", pa.binary()), ("scores", pa.binary()),
    ("best", pa.list_(pa.struct([("slot", pa.int32()), ("score", pa.int64())]))),
])
_FOUND = "bundle bigint, slot int, doc_id bigint, score bigint"
_FOUND_SCHEMA = pa.schema([("bundle", pa.int64()), ("slot", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _add(state: dict, lists: pa.Table, n: int, length: int) -> np.ndarray:
    """Accumulators (item by document) with what the owner's lists add."""
    sizes = np.array(state["sizes"], np.int64)
    norm = 8 * (100 - 75 + (75 * sizes * n) // length)
    row_of = np.zeros(BUNDLE, np.int64)
    row_of[state["slots"]] = np.arange(len(state["slots"]))
    scores = np.zeros((len(state["slots"]), len(sizes)), np.int64)
    if state["docs"] is not None:
        scores[np.repeat(np.arange(len(scores)), state["held"]), np.frombuffer(state["docs"], "<u2")] = np.frombuffer(state["scores"], "<i8")
    for r in lists.to_pylist():
        docs, tfs = np.frombuffer(r["docs"], "<u2").astype(np.int64), np.frombuffer(r["tfs"], "<u4").astype(np.int64)
        gain = r["w"] * ((1_000_000_000 * tfs) // (1000 * tfs + norm[docs]))
        rows = row_of[[u["slot"] for u in r["uses"]]]
        scores[rows[:, None], docs] += np.array([u["q"] for u in r["uses"]], np.int64)[:, None] * gain
    return scores


def _stage(k: int, owner: int, owners: int, n: int, length: int):
    """The cogrouped work of one owner on one bundle and shard."""

    def add(key, bundles: pa.Table, lists: pa.Table) -> pa.Table:
        state = bundles.to_pylist()[0]
        scores = _add(state, lists, n, length)
        slots = state["slots"]
        most = min(k, scores.shape[1])
        if owner == owners - 1:
            ids, found = state["doc_ids"], []
            for row, slot in enumerate(slots):
                line = scores[row]
                places = np.flatnonzero(line > 0)
                if len(places) > k:  # with all that equal the k-th
                    places = places[line[places] >= np.partition(line[places], -k)[-k]]
                first = sorted(places.tolist(), key=lambda i: (-line[i], ids[i] is not None, ids[i] or 0))[:k]
                found += [(state["bundle"], slot, ids[i], int(line[i])) for i in first]
            columns = zip(*found) if found else [[]] * 4
            return pa.table([pa.array(c, f.type) for c, f in zip(columns, _FOUND_SCHEMA)], schema=_FOUND_SCHEMA)
        known = dict(state["floors"] or [])
        floor = np.array([known.get(s, 0) for s in slots], np.int64)
        best = -np.partition(-scores, most - 1, axis=1)[:, :most]
        if most == k:
            floor = np.maximum(floor, best.min(axis=1))
        rest = np.array(state["rests"], np.int64).reshape(len(slots), owners)[:, owner + 1 :].sum(axis=1)
        rows, places = np.nonzero((scores > 0) & (scores + rest[:, None] >= floor[:, None]))
        tops = [{"slot": s, "score": int(x)} for s, line in zip(slots, best) for x in line if x > 0]
        out = state | {
            "held": np.bincount(rows, minlength=len(slots)), "docs": places.astype("<u2").tobytes(), "scores": scores[rows, places].astype("<i8").tobytes(), "best": tops,
        }
        return pa.table([pa.array([out[f.name]], f.type) for f in _STATE_SCHEMA], schema=_STATE_SCHEMA)

    return add


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring of ``docs``
    (``doc_id, text``) for each of ``items`` (``item_id, text``)."""
    owners = len(OWNERS) + 1
    asked = items.select("item_id", "text")
    number = F.monotonically_increasing_id()
    asked = stored(asked.coalesce(asked.count() // ITEMS_A_PART + 1).withColumn("_number", number))
    asked = asked.select("item_id", "text", F.floor(F.col("_number") / BUNDLE).alias("bundle"), (F.col("_number") % BUNDLE).cast("int").alias("slot"))
    uses = stored(item_terms(asked))
    terms = uses.select("term").distinct()
    rows = index(docs, terms)
    n, length = rows.where("doc_ids IS NOT NULL").agg(F.sum("n_docs"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    n, length = n or 0, length or 0

    # weights and owners of the terms that items use
    postings = rows.where("term IS NOT NULL")
    held = postings.groupBy("term").agg(F.sum("n_docs").alias("df"))
    owner = F.lit(owners - 1)
    for number, share in reversed([*enumerate(OWNERS)]):
        owner = F.when(F.col("df") <= share * n, number).otherwise(owner)
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1)))
    weighed = stored(uses.join(held, "term").select("bundle", "slot", "term", "q", weight.cast("long").alias("w"), owner.alias("owner")))
    users = weighed.groupBy("bundle", "term", "w", "owner").agg(F.collect_list(F.struct("slot", "q")).alias("uses"))
    lists = stored(postings.join(users, "term").select("bundle", "shard", "owner", "w", "uses", "docs", "tfs"))

    # a bundle: its items and what each owner can add to them at most
    most = [F.sum(F.when(F.col("owner") == o, F.col("q") * F.col("w") * _IMPACT).otherwise(0)).alias(f"m{o}") for o in range(owners)]
    limits = weighed.groupBy("bundle", "slot").agg(*most).select("bundle", F.struct("slot", F.array(*[f"m{o}" for o in range(owners)]).alias("most")).alias("item"))
    bundles = limits.groupBy("bundle").agg(F.sort_array(F.collect_list("item")).alias("of"))
    bundles = bundles.select("bundle", F.col("of.slot").alias("slots"), F.flatten("of.most").alias("rests"))
    shards = rows.where("doc_ids IS NOT NULL").select("shard", "doc_ids", "sizes")
    state = stored(lists.select("bundle", "shard").distinct().join(bundles, "bundle").join(shards, "shard"))
    state = state.withColumns({"held": F.lit(None).cast("array<int>"), "docs": F.lit(None).cast("binary"), "scores": F.lit(None).cast("binary"), "floors": F.lit(None).cast("map<int, bigint>")})
    by_score = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"))
    for o in range(owners):
        own = lists.where(F.col("owner") == o)
        pairs = state.groupBy("bundle", "shard").cogroup(own.groupBy("bundle", "shard"))
        if o == owners - 1:
            found = pairs.applyInArrow(_stage(k, o, owners, n, length), _FOUND)
            break
        state = stored(pairs.applyInArrow(_stage(k, o, owners, n, length), _STATE))
        tops = state.select("bundle", F.inline("best")).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        floors = tops.where(F.col("rank") == k).groupBy("bundle").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("floors"))
        state = state.drop("best").join(floors, "bundle", "left")

    order = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("bundle", "slot", "item_id"), ["bundle", "slot"]).select("item_id", "rank", "doc_id", "score")


_WORDS = f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}')"
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, len({_WORDS}) AS n, {_WORDS} AS t FROM documents WHERE len({_WORDS}) > 0),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_words FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM d) GROUP BY doc_id, n, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest({_WORDS}) AS term FROM benchmark) GROUP BY item_id, term),
w AS (SELECT item_id, term, q, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM q JOIN df USING (term), totals),
sums AS (
  SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // n_words)))))::BIGINT AS score
  FROM w JOIN tf USING (term), totals GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM sums WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
