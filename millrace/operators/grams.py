"""N-gram counts, put together in the tasks and moved as packed text.

An n-gram is ``n`` times as long as its share of the text, and as a row of its
own it is longer still. So each task cuts its texts into words itself, as the
pattern of ``functions.text`` does, some megabytes at a time, and tells their
n-grams apart as numbers made of the words' places in a dictionary of those
texts, exactly. Each different n-gram goes once to its part, by the hash of its
words, with its count and the number of texts it is in; the n-grams that go to
one part are one packed value. Spark shuffles the parts, and each is added up
in one group. A part holds the n-grams of ``PART`` bytes of text on average, so
there are more parts the more text there is, and an n-gram that is everywhere
comes once per slice of text to its part.

A text is a document unless rows share an id. Only those rows are numbered, and
their n-grams travel with the number, so that a document counts once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import discard, shuffle_width, stored

SLICE = 1 << 23  # bytes of texts whose n-grams are formed at once
PART = 1 << 22
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CELL = "part int, size bigint, held bigint, shared bigint, packed binary"


def _former(n: int, parts: int, size: int):
    """Task function: the counted n-grams of texts ``(text, id)`` that end in a
    line break, as rows of ``_CELL``: ``held`` n-grams in ``size`` bytes, each
    word with a blank behind it, their counts, their numbers of texts without
    id, and ``shared`` places of n-grams with the ids they were seen in. All it
    needs is local, so executors get it without this package."""
    mix = _MIX

    def slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        """Bytes of some texts, where each begins, and their ids."""
        texts = batch.column(0).cast(pa.large_string())
        if not len(texts):
            return
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data, ids = np.frombuffer(texts.buffers()[2], np.uint8), batch.column(1).to_numpy()
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield data[offsets[at] : offsets[to]], offsets[at:to] - offsets[at], ids[at:to]
            at = to

    def cut(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Of every word its text and its place in the dictionary."""
        inside = (data - np.uint8(97)) < 26
        first, kept = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        kept[1:] |= inside[:-1]
        letters = np.where(inside, data, np.uint8(32))[kept]
        offsets = np.concatenate([[0], np.flatnonzero(letters == 32) + 1])
        words = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
        return np.searchsorted(begins, np.flatnonzero(first), "right") - 1, words.dictionary, words.indices.to_numpy().astype(np.int64)

    def numbered(own: np.ndarray, words: int) -> np.ndarray:
        """A number for the n-gram at each place, the same for equal ones."""
        m = len(own) - n + 1
        key, width = own[:m], words
        for j in range(1, n):
            if width > (1 << 62) // words:
                known, key = np.unique(key, return_inverse=True)
                width = len(known)
            key, width = key * words + own[j : m + j], width * words
        return key

    def cells(data: np.ndarray, begins: np.ndarray, ids: np.ndarray) -> Iterator[tuple]:
        text, words, own = cut(data, begins)
        if len(own) < n:
            return
        place = np.flatnonzero(text[: len(own) - n + 1] == text[n - 1 :])
        key = numbered(own, len(words))[place]
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
        at = np.flatnonzero(fresh)
        if not len(at):
            return
        of = text[place]
        in_text = fresh.copy()  # the first of its kind in its text
        in_text[1:] |= of[1:] != of[:-1]
        apart = in_text & (ids[of] < 0)
        counts, books = np.diff(np.append(at, len(key))), np.add.reduceat(apart.astype(np.int64), at)
        shared = np.flatnonzero(in_text & ~apart)
        gram, doc = np.cumsum(fresh)[shared] - 1, ids[of[shared]]

        place = place[at]
        crc = np.array([zlib.crc32(w) for w in words.cast(pa.large_binary()).to_pylist()], np.uint64)
        mixed = np.zeros(len(place), np.uint64)
        for j in range(n):
            mixed = (mixed ^ crc[own[place + j]]) * mix
            mixed ^= mixed >> np.uint64(29)
        part = ((mixed >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, place, counts, books = part[order], place[order], counts[order].astype(np.int32), books[order].astype(np.int32)
        moved = np.empty(len(order), np.int64)
        moved[order] = np.arange(len(order))
        gram = moved[gram]
        by_gram = np.argsort(gram, kind="stable")
        gram, doc = gram[by_gram], doc[by_gram]

        spelled = pc.binary_join_element_wise(*[words.take(pa.array(own[place + j])) for j in range(n)], pa.scalar("", pa.large_string()))
        offsets, letters = np.frombuffer(spelled.buffers()[1], np.int64), memoryview(spelled.buffers()[2])
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = np.append(starts[1:], len(part))
        shares = np.searchsorted(gram, np.append(starts, len(part)))
        for i, j, x, y in zip(starts.tolist(), ends.tolist(), shares[:-1].tolist(), shares[1:].tolist()):
            line = letters[offsets[i] : offsets[j]]
            raw = b"".join([line, counts[i:j].tobytes(), books[i:j].tobytes(), (gram[x:y] - i).astype(np.int32).tobytes(), doc[x:y].tobytes()])
            yield int(part[i]), len(line), j - i, y - x, pa.compress(raw, codec="zstd", asbytes=True)

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()
        for batch in batches:
            for some in slices(batch):
                columns = list(zip(*cells(*some))) or [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["part", "size", "held", "shared", "packed"])

    return form


def _adder(n: int):
    """Task function: the different n-grams of a part, added up."""

    def add(part: pa.Table) -> pa.Table:
        lines, counts, books, grams, docs, before = [], [], [], [], [], 0
        for size, held, shared, packed in zip(*(part.column(c).to_pylist() for c in ("size", "held", "shared", "packed"))):
            raw = pa.decompress(packed, decompressed_size=size + 8 * held + 12 * shared, codec="zstd", asbytes=True)
            lines.append(memoryview(raw)[:size])
            counts.append(np.frombuffer(raw, np.int32, held, size))
            books.append(np.frombuffer(raw, np.int32, held, size + 4 * held))
            grams.append(np.frombuffer(raw, np.int32, shared, size + 8 * held).astype(np.int64) + before)
            docs.append(np.frombuffer(raw, np.int64, shared, size + 8 * held + 4 * shared))
            before += held
        letters = np.frombuffer(b"".join(lines), np.uint8)
        offsets = np.concatenate([[0], np.flatnonzero(letters == 32)[n - 1 :: n] + 1])
        found = pa.LargeStringArray.from_buffers(before, pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
        code, known = found.indices.to_numpy(), len(found.dictionary)
        total = lambda values: np.bincount(code, weights=np.concatenate(values), minlength=known).astype(np.int64)
        gram, doc = code[np.concatenate(grams)], np.concatenate(docs)
        order = np.lexsort((doc, gram))
        gram, doc = gram[order], doc[order]
        other = np.concatenate([[True], (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])])[: len(gram)]
        return pa.table({
            "ngram": pc.ascii_rtrim_whitespace(found.dictionary).cast(pa.string()),
            "n": total(counts),
            "books": total(books) + np.bincount(gram[other], minlength=known),
        })

    return add


def ngram_counts(docs: DataFrame, doc: str, text: str | Column, n: int) -> DataFrame:
    """``(ngram, n, books)``: occurrences of each n-gram, and the number of
    documents it is in; rows without an id are one document."""
    docs = docs.select(F.col(doc).alias("doc"), (F.col(text) if isinstance(text, str) else text).alias("text")).where("text IS NOT NULL")
    ids = stored(docs.groupBy("doc").agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("size")))
    size, most = ids.agg(F.sum("size"), F.max("rows")).first()
    if (most or 0) > 1:
        several = stored(ids.where("rows > 1").select(F.col("doc").alias("of"), F.monotonically_increasing_id().alias("id")))
        docs = docs.join(several, F.col("doc").eqNullSafe(F.col("of")), "left")
    else:
        docs = docs.withColumn("id", F.lit(None).cast("bigint"))
    discard(ids)
    parts = max(2 * shuffle_width(docs.sparkSession), (size or 0) // PART)
    texts = docs.select(F.concat(F.lower("text"), F.lit("\n")).alias("text"), F.coalesce("id", F.lit(-1)).cast("bigint").alias("id"))
    formed = texts.mapInArrow(_former(n, parts, SLICE), _CELL)
    return formed.groupBy("part").applyInArrow(_adder(n), "ngram string, n bigint, books bigint")
