"""Token ids in files of directly addressable codes.

A segment holds the ids of consecutive documents. Every id is cut into 8-bit
chunks; level 0 has the lowest chunk of all ids, level 1 the next chunk of
those ids that have one, and so on. A bitmap per level says which ids go on,
and a directory holds the count of set bits before every 512-bit block, so
any id is found with one rank step per level, without decoding its
neighbours.

Layout, little-endian: ``b"DAC1"``, documents u32, ids u64, levels u32; per
level the chunks u64; documents+1 first places u64; then per level the chunk
bytes, the bitmap (padded to 64 bytes) and the directory (u64 per block).

``write`` puts one segment per row into a Parquet table. Parquet carries the
binary segments through Spark's commit protocol, so a retried task leaves no
second copy, and the metadata beside the segment can be read alone.

Cases: null or empty text is the end id alone. Rows with the same doc_id are
all written, ordered by the beginnings of their texts (null first), then by a
hash; such rows, and copies of one row, may lie in several parts. A null
doc_id comes first. No rows: no segment.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm import tokens
from millrace.session import stored

_BLOCK = 512
_MAGIC = b"DAC1"
BEGINNING = 64  # characters of a text that take part in the order
SEGMENT_IDS = 1 << 20  # a segment ends with the document that reaches this many ids


def pack(ids: np.ndarray, sizes: list[int]) -> bytes:
    """Segment of the documents whose ids follow each other in ``ids``."""
    levels, rest = [], np.asarray(ids, np.uint32)
    while len(rest) or not levels:
        goes_on = rest > 0xFF
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (_BLOCK // 8), np.uint8)])
        ones = np.bitwise_count(bits.view(np.uint64)).reshape(-1, _BLOCK // 64).sum(1, dtype=np.uint64)
        levels.append(((rest & 0xFF).astype(np.uint8), bits, np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u8") if len(ones) else ones))
        rest = rest[goes_on] >> np.uint32(8)
    first = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype("<u8")
    head = struct.pack("<4sIQI", _MAGIC, len(sizes), len(ids), len(levels))
    out = [head, np.array([len(c) for c, _, _ in levels], "<u8").tobytes(), first.tobytes()]
    for part in levels:
        out += [x.tobytes() for x in part]
    return b"".join(out)


class Segment:
    """Random access into one segment."""

    def __init__(self, data: bytes):
        magic, documents, self.n_ids, n_levels = struct.unpack_from("<4sIQI", data)
        if magic != _MAGIC:
            raise ValueError("not a segment of token ids")
        at = struct.calcsize("<4sIQI")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        sizes = take("<u8", n_levels)
        self.first = take("<u8", documents + 1).astype(np.int64)
        self.levels = []
        for n in sizes.tolist():
            blocks = -(-n // _BLOCK)
            self.levels.append((take("u1", n), take("u1", blocks * _BLOCK // 8), take("<u8", blocks)))

    def _rank(self, level: int, i: int) -> int:
        """Set bits before bit ``i``."""
        _, bits, before = self.levels[level]
        block = i // _BLOCK
        byte = bits[block * _BLOCK // 8 : i // 8]
        tail = int(bits[i // 8]) & ((1 << i % 8) - 1) if i % 8 else 0
        return int(before[block]) + int(np.bitwise_count(byte).sum()) + tail.bit_count()

    def get(self, i: int) -> int:
        """Id number ``i``."""
        out = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            out |= int(chunks[i]) << 8 * level
            if not bits[i // 8] >> i % 8 & 1:
                return out
            i = self._rank(level, i)
        return out

    def span(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``, touching only their chunks."""
        out, places = np.zeros(max(0, stop - start), np.uint32), None
        for level, (chunks, bits, before) in enumerate(self.levels):
            if stop <= start:
                break
            mine = chunks[start:stop].astype(np.uint32) << np.uint32(8 * level)
            flags = np.unpackbits(bits[start // 8 : -(-stop // 8)], bitorder="little")[start % 8 :][: stop - start].astype(bool)
            if places is None:
                out[:] = mine
                places = np.flatnonzero(flags)
            else:
                out[places] |= mine
                places = places[flags]
            if not len(places):
                break
            begin = self._rank(level, start)
            start, stop = begin, begin + len(places)
        return out

    def document(self, i: int) -> np.ndarray:
        return self.span(int(self.first[i]), int(self.first[i + 1]))


def write(docs: DataFrame, tokenizer: str, end_id: int, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Encode every text and write the segments; returns the written table:
    ``part, seq`` (order of the segments), ``doc_ids``, ``n_ids``, ``segment``.

    Rows are range-partitioned by doc_id and, for rows that share one, by text,
    so segments follow each other in that order and each task writes its own.
    """

    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("segment", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, part, seq = tokens.encoder(tokenizer), TaskContext.get().partitionId(), 0
        names, ids, size = [], [], 0

        def segment() -> pa.RecordBatch:
            blob = pack(np.concatenate(ids), [len(x) for x in ids])
            return pa.record_batch([[part], [seq], [names], [size], [blob]], schema=schema)

        for batch in batches:
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), tokens.documents(use, batch.column("text"), end_id)):
                names.append(doc_id)
                ids.append(found)
                size += len(found)
                if size >= segment_ids:
                    yield segment()
                    names, ids, size, seq = [], [], 0, seq + 1
        if ids:
            yield segment()

    order = ["doc_id", F.substring("text", 1, BEGINNING), F.xxhash64("text")]
    # equal rows give the same ids in any order
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    return stored(rows.mapInArrow(encode, "part int, seq int, doc_ids array<bigint>, n_ids bigint, segment binary"))


def read(segments: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from the files.

    Places before a segment come in two steps: totals per part (as many rows
    as there were write tasks), then a running sum inside each part.
    """
    sizes = segments.select("part", "seq", "n_ids")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
        .join(parts, "part")
        .select("part", "seq", (F.col("inside") + F.col("part_start")).alias("before"))
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                segment = Segment(r["segment"])
                sums = [zlib.crc32(segment.document(i).astype("<u4").tobytes()) for i in range(len(r["doc_ids"]))]
                n = len(sums)
                columns = {"part": [r["part"]] * n, "seq": [r["seq"]] * n, "doc_id": r["doc_ids"], "inside": segment.first[:-1], "n_tokens": np.diff(segment.first), "ids_crc32": sums}
                yield pa.record_batch([pa.array(columns[f.name], f.type) for f in found], schema=found)

    found = pa.schema([("part", pa.int32()), ("seq", pa.int32()), *((c, pa.int64()) for c in ("doc_id", "inside", "n_tokens", "ids_crc32"))])
    read_back = segments.select("part", "seq", "doc_ids", "segment").mapInArrow(
        decode, "part int, seq int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return read_back.join(starts, ["part", "seq"]).select("doc_id", (F.col("inside") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
