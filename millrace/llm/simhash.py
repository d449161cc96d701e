"""Near copies by SimHash fingerprints that differ in few bits.

Equal fingerprints are one node. Others are found in the space of segment
counts: the 64 bits make segments of 4, and a fingerprint's cell is the number
of set bits in each segment. A differing bit changes one count by one, so the
Manhattan distance of two cells never exceeds the bit distance of their
fingerprints. Two cells at distance 2 or less share a cell at distance 1 or
less from both: each fingerprint goes to its own cell and the ones next to it,
meets there all that can be near, and every meeting is verified on the bits. A
rule on the two steps picks one of several common cells, so a pair meets once.

A cell of more than ``CROWD`` fingerprints makes no pairs; its members are
dealt out anew on a finer grid, of segments of 2 bits, where the same bound
holds. What is crowded even there goes to the finest one, of segments of one
bit: a cell is then a fingerprint, and instead of pairs every member of a cell
is linked to the smallest there. Two that meet on that grid are at most two
bits apart, so this gives the same components with linear work.

Cases: null, empty and blank texts have fingerprint 0 and link like others.
Texts shorter than a shingle are one shingle. Rows with the same doc_id keep
a row each; a null doc_id counts as larger than all others. No rows give no
rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.components import connected
from millrace.llm.text import SPACED_BYTES, Words, batches
from millrace.session import stored

SEED = 42
CROWD = 32
GRIDS = (4, 2)  # bits of a segment, coarse to fine; the last grid, of 1 bit, is apart

# The primes of XXH64
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
_LONG = 32  # bytes from which XXH64 works in stripes; few shingles are so long


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return x << np.uint64(n) | x >> np.uint64(64 - n)


def shingle_hashes(data: bytes, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """XXH64 of the byte strings ``data[start:stop]``, all together; the
    library is asked for those of ``_LONG`` bytes or more."""
    size = stops - starts
    padded = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(8, np.uint8)])
    eights = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    fours = np.ndarray((len(padded) - 3,), "<u4", padded, 0, (1,))
    h = np.uint64(SEED) + _P5 + size.astype(np.uint64)
    at = starts.copy()
    for _ in range(_LONG // 8 - 1):
        go = np.flatnonzero(stops - at >= 8)
        word = _turn(eights[at[go]] * _P2, 31) * _P1
        h[go] = _turn(h[go] ^ word, 27) * _P1 + _P4
        at[go] += 8
    go = np.flatnonzero(stops - at >= 4)
    h[go] = _turn(h[go] ^ fours[at[go]].astype(np.uint64) * _P1, 23) * _P2 + _P3
    at[go] += 4
    for _ in range(3):
        go = np.flatnonzero(stops - at >= 1)
        h[go] = _turn(h[go] ^ padded[at[go]].astype(np.uint64) * _P5, 11) * _P1
        at[go] += 1
    h = (h ^ h >> np.uint64(33)) * _P2
    h = (h ^ h >> np.uint64(29)) * _P3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(size >= _LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : stops[i]], SEED)
    return h


def _ones(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many of each text's hashes have each bit; every text has one."""
    out = np.zeros((len(first) - 1, 64), np.int64)
    for text in range(0, len(out), 256):
        some = first[text : text + 257]
        for low in range(int(some[0]), int(some[-1]), 1 << 16):
            high = min(low + (1 << 16), int(some[-1]))
            bits = np.unpackbits(hashes[low:high].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            # texts that begin in this part, and the one that goes on into it
            begin = int(np.searchsorted(some, low, "right")) - 1
            end = int(np.searchsorted(some[:-1], high))
            cuts = np.maximum(some[begin:end] - low, 0)
            out[text + begin : text + end] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    return out


def batch_fingerprints(texts: Sequence[bytes | None], words: int = 3) -> np.ndarray:
    """64-bit SimHash of each text as a signed number: a bit is 1 if more than
    half of all shingles have it."""
    out = np.zeros(len(texts), np.int64)
    for start, run in batches(texts):
        found = Words(run, SPACED_BYTES)
        held = np.diff(found.first)
        some = np.flatnonzero(held)
        if not len(some):
            continue
        # words one blank apart, so that a shingle is a range of bytes
        line = b" ".join(found.data.split())
        ends = np.cumsum(found.end - found.start + 1) - 1
        begins = ends - (found.end - found.start)
        n = np.maximum(1, held[some] - words + 1)
        low = np.repeat(found.first[:-1][some] - np.cumsum(n) + n, n) + np.arange(n.sum())
        high = np.minimum(low + words, np.repeat(found.first[1:][some], n)) - 1
        hashes = shingle_hashes(line, begins[low], ends[high])
        ones = _ones(hashes, np.concatenate([[0], np.cumsum(n)]))
        out[start + some] = np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view(np.int64)[:, 0]
    return out


def fingerprint(text: bytes | None, words: int = 3) -> int:
    return int(batch_fingerprints([text], words)[0])


def fingerprints(text: str, words: int = 3) -> Column:
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(batch_fingerprints(texts.tolist(), words))

    return of(F.col(text).cast("binary"))


def _long(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >= 1 << 63 else value).cast("long")


def _cell(fp: Column, width: int) -> Column:
    """Set bits of each segment of ``width`` bits, in the segment's place."""
    low, high = (x.bitwiseAND(_long(0x5555555555555555)) for x in (fp, F.shiftrightunsigned(fp, 1)))
    twos = low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
    if width == 2:
        return twos
    pairs = _long(0x3333333333333333)
    return twos.bitwiseAND(pairs) + F.shiftrightunsigned(twos, 2).bitwiseAND(pairs)


def _steps(width: int) -> Column:
    """The own cell (step 0) and those one count away (steps ±1, ±2, ...)."""
    cell, top = F.col("cell"), (1 << width) - 1
    out = [F.struct(cell.alias("spot"), F.lit(0).alias("step"))]
    for i in range(64 // width):
        count = F.shiftrightunsigned(cell, width * i).bitwiseAND(top)
        others = cell.bitwiseAND(_long(~(top << width * i) & (1 << 64) - 1))
        next_to = lambda by: others.bitwiseOR(F.shiftleft(count + by, width * i))
        out.append(F.when(count < width, F.struct(next_to(1).alias("spot"), F.lit(i + 1).alias("step"))))
        out.append(F.when(count > 0, F.struct(next_to(-1).alias("spot"), F.lit(-i - 1).alias("step"))))
    return F.array_compact(F.array(*out))


def _meet_once() -> Column:
    """For l.fp < r.fp: whether this common cell is the one that counts."""
    a, b = F.col("l.step"), F.col("r.step")
    return (
        ((a == 0) & (b == 0))
        | ((a == 0) & (b != 0))
        | ((a != 0) & (b != 0) & (a != b) & (F.abs(a) <= F.abs(b)))
    )


def _flips(max_bits: int) -> Column:
    """Values that two fingerprints share exactly when they are near."""
    fp = F.col("fp")
    if max_bits == 2:
        return F.array(fp, *[fp.bitwiseXOR(_long(1 << i)) for i in range(64)])
    return F.array(*[F.xxhash64(F.lit(i), fp.bitwiseAND(_long(~(1 << i) & (1 << 64) - 1))) for i in range(64)])


def _spread_join(exploded: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Inner join of which neither side is broadcast: Spark takes a table with
    an exploded column for as small as the one before."""
    return exploded.join(side.hint("merge"), key)


def _met(prints: DataFrame, width: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """Near pairs ``a, b`` from the cells of a grid, and the fingerprints of
    its crowded cells."""
    spots = prints.withColumn("cell", _cell(F.col("fp"), width))
    spots = spots.select("fp", F.explode(_steps(width)).alias("s")).select("fp", "s.spot", "s.step")
    busy = spots.groupBy("spot").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(_spread_join(spots, busy, "spot"))
    few = met.where(F.col("n") <= CROWD).drop("n")
    near = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= max_bits
    pairs = (
        few.alias("l")
        .join(few.alias("r").hint("merge"), (F.col("l.spot") == F.col("r.spot")) & (F.col("l.fp") < F.col("r.fp")) & _meet_once() & near)
        .select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))
    )
    return pairs, stored(met.where(F.col("n") > CROWD).select("fp").distinct())


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links ``a, b`` whose components are those of all pairs of distinct
    ``fp`` that differ in at most ``max_bits`` bits."""
    if max_bits not in (1, 2):
        raise ValueError("max_bits is 1 or 2")
    out, left = None, prints.select("fp").distinct()
    for width in GRIDS:
        pairs, left = _met(left, width, max_bits)
        out = pairs if out is None else out.union(pairs)
        if left.isEmpty():
            return out
    # the finest grid: a cell is a fingerprint
    balls = left.select("fp", F.explode(_flips(max_bits)).alias("value"))
    least = balls.groupBy("value").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    stars = _spread_join(balls, least, "value").where("fp > b").select(F.col("fp").alias("a"), "b").distinct()
    return out.union(stars)


def _rows(docs: DataFrame, words: int) -> DataFrame:
    names = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), fingerprints("text", words).alias("fp"))
    return stored(names)


def _groups(rows: DataFrame, max_bits: int) -> DataFrame:
    """``fp, component`` (some fingerprint that stands for the group)."""
    prints = rows.select("fp").distinct()
    found = prints.join(connected(links(rows, max_bits)), F.col("fp") == F.col("node"), "left")
    return found.select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest doc_id reachable over links."""
    rows = _rows(docs, words)
    groups = _groups(rows, max_bits).join(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp")
    first = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    names = stored(groups.join(first, "component").select("fp", "component_id"))
    return rows.join(names, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs``, one of each group of near copies: the one of
    smallest doc_id."""
    rows = _rows(docs, words)
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash")
    least = rows.groupBy("fp").agg(F.min(order).alias("least"))
    groups = _groups(rows, max_bits).join(least, "fp")
    kept = groups.groupBy("component").agg(F.min("least").alias("least")).select("least.doc_id", "least.text_hash")
    kept = stored(kept.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    whole = whole.withColumns({"id": F.col("doc.doc_id").cast("long"), "hash": F.xxhash64("doc.text")})
    found = whole.join(kept, F.col("kept_id").eqNullSafe(F.col("id")) & (F.col("kept_hash") == F.col("hash")), "left_semi")
    # rows repeated as they are: only these are ordered
    again = stored(rows.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")))
    same = F.col("kept_id").eqNullSafe(F.col("id")) & (F.col("kept_hash") == F.col("hash"))
    single = found.join(again, same, "left_anti").select("doc.*")
    copy = F.row_number().over(Window.partitionBy("id", "hash").orderBy(F.to_json("doc")))
    several = found.join(again, same, "left_semi").withColumn("copy", copy).where("copy = 1").select("doc.*")
    return single.unionByName(several)


def hex_digits(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
