"""Best-fit packing of documents into sequences of a fixed number of tokens.

Only documents longer than a sequence are cut; their first piece takes the
remainder, the others are full. Pieces of one length are interchangeable, so
the packing is planned on the count of each length, a table of at most
``capacity`` rows however large the corpus:

* lengths above a third of the capacity are matched: from the longest, each
  takes the longest partner that still fits, at most two per sequence. That
  greedy matching pairs as many as any matching can.
* shorter lengths go, longest first, into the tightest gap that takes them.

The plan is a list of runs: the pieces number ``low`` to ``high`` of a length
go to sequences ``first``, ``first+1``, ... at ``offset``. Pieces get their
number within their length by counts per (bucket, length), so no task sees
all pieces of one length.

Cases: null or empty text is the end id alone. Rows with the same doc_id, or
a null one, are packed each on its own. No rows give no rows. Columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm import tokens
from millrace.session import shuffle_width, stored

CAPACITY = 1024
ROWS_PER_BUCKET = 200_000


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``n`` ids."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    starts = range(first, n, capacity)
    return ([(0, first)] if first else []) + [(s, capacity) for s in starts]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Runs ``(length, low, high, first, offset)`` and the number of sequences."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    by_gap: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]

    def put(items: tuple[int, ...], n: int) -> None:
        if n:
            by_gap[capacity - sum(items)].append((items, n))

    third = capacity // 3
    for a in range(capacity, third, -1):
        b = min(a, capacity - a)
        while left[a] and b > third:
            if a == b:
                n = left[a] // 2
                left[a] -= 2 * n
            else:
                n = min(left[a], left[b])
                left[a] -= n
                left[b] -= n
            put((a, b), int(n))
            b -= 1
        put((a,), int(left[a]))
        left[a] = 0
    for s in range(third, 0, -1):
        n = int(left[s])
        while n:
            gap = next((g for g in range(s, capacity + 1) if by_gap[g]), None)
            if gap is None:
                each = capacity // s
                put((s,) * each, n // each)
                put((s,) * (n % each), int(n % each > 0))
                break
            items, bins = by_gap[gap].pop()
            each = min(gap // s, n)
            full = min(bins, n // each)
            put(items, bins - full)
            put(items + (s,) * each, full)
            n -= full * each
    runs, used, first = [], np.zeros(capacity + 1, np.int64), 0
    for group in by_gap:
        for items, n in group:
            offset = 0
            for s in items:
                runs.append((s, used[s], used[s] + n, first, offset))
                used[s] += n
                offset += s
            first += n
    return np.array(sorted(runs), np.int64).reshape(-1, 5), first


def document_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of all documents, and
    ``nth``, the document's number in its task, which tells equal rows apart."""

    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("nth", pa.int64())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, nth = tokens.encoder(tokenizer), 0
        for batch in batches:
            out = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.documents(use, batch.column("text"), end_id)):
                ids = ids.astype("<u4", copy=False)
                out += [(doc_id, i, s, n, zlib.crc32(ids[s : s + n]), nth) for i, (s, n) in enumerate(cut(len(ids), capacity))]
                nth += 1
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(encode, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, nth bigint")


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    spark = docs.sparkSession
    pieces = stored(document_pieces(docs, tokenizer, end_id, capacity))
    # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs, _ = plan(counts, capacity)
    keys, lows, firsts, offsets = runs[:, 0], runs[:, 1], runs[:, 3], runs[:, 4]
    begin = np.searchsorted(keys, np.arange(capacity + 2))

    # a window numbers the pieces of one length and bucket
    buckets = max(shuffle_width(spark), max(counts.values(), default=0) // ROWS_PER_BUCKET)
    spot = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "nth"), F.lit(buckets)).cast("int"))
    sizes = spot.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length, number = frame["length"].to_numpy(), frame["number"].to_numpy()
            run = np.empty(len(frame), np.int64)
            for n in np.unique(length):
                mine = length == n
                run[mine] = begin[n] + np.searchsorted(lows[begin[n] : begin[n + 1]], number[mine], "right") - 1
            yield frame.drop(columns="number").assign(sequence_id=firsts[run] + number - lows[run], offset=offsets[run])

    numbered = (
        spot.withColumn("inside", inside)
        .join(before, ["length", "bucket"])
        .select(F.col("doc_id").cast("string").alias("doc_id"), "piece", "start", "length", "ids_crc32", (F.col("inside") + F.col("before")).alias("number"))
    )
    placed = numbered.mapInPandas(place, "doc_id string, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
    return placed.withColumn("doc_id", F.col("doc_id").cast("long"))
