"""Pairs of words that stand near each other, formed and told apart as numbers.

A pair of strings is dear to form, to hash and to move, and a text has several
pairs per word. So each task cuts its texts into words itself, as the pattern
of ``functions.text`` does, some megabytes at a time. A word of up to 12
letters is a number, 5 bits a letter, exactly; pairs with a longer word stay
text. Different pairs are dealt by hash into parts, which Spark shuffles, and
each part is added up in one group. A part holds the pairs of ``PART`` bytes of
text on average, so there are more parts the more text there is, and a pair
that is everywhere comes once per run of words to its part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import shuffle_width

RUN = 1 << 21  # words whose pairs are formed at once
SLICE = 1 << 23  # bytes of texts that are cut into words at once
PART = 1 << 22
_CODE = 22  # bits of a word's number within a run
_PARTS = 1 << 63 - 2 * _CODE
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _former(distances: Sequence[int], dropped: Sequence[str], least: int, parts: int, run: int, size: int):
    """Task function: the counted pairs of texts as rows ``(part, a, b, n,
    long)``. Numbers of words and counts travel as bytes, pairs with a long
    word as lines. All it needs is local, so executors get it without this
    package."""
    short, code_bits, mixers, reach = 12, _CODE, _MIX, max(distances)

    def number(word: str) -> int:
        return sum(ord(c) - 96 << 5 * (short - 1 - i) for i, c in enumerate(word))

    plain = [w for w in dropped if w.isascii() and w.isalpha() and w.islower()]
    stop = np.array(sorted(number(w) for w in plain if len(w) <= short), np.uint64)
    stopped = set(stop.tolist())
    long_stop = {w.encode() for w in plain if len(w) > short}

    def slices(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Bytes of some texts, and where each begins."""
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        if not len(texts) or offsets[-1] == offsets[0]:
            return
        data = np.frombuffer(texts.buffers()[2], np.uint8)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield data[offsets[at] : offsets[to]], offsets[at:to] - offsets[at]
            at = to

    def cut(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of every word its text, start, length and number, 0 if it is long."""
        letters = np.concatenate([data, np.zeros(short, np.uint8)])
        inside = (letters - np.uint8(97)) < 26
        fresh = np.zeros(len(letters), bool)
        fresh[begins[begins < len(data)]] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | fresh[1:]
        last = inside[:-1] & (~inside[1:] | fresh[1:])
        start = np.flatnonzero(first)
        length = np.flatnonzero(last) + 1 - start
        text = np.searchsorted(begins, start, "right") - 1
        if least > 1:
            enough = (np.bincount(text, minlength=len(begins)) >= least)[text]
            text, start, length = text[enough], start[enough], length[enough]
        code = np.zeros(len(start), np.uint64)
        for i in range(short):
            code <<= np.uint64(5)
            code |= np.where(length > i, letters[start + i] - np.uint8(96), np.uint8(0))
        code[length > short] = 0
        return text, start, length, code

    def as_numbers(text: np.ndarray, code: np.ndarray):
        known, own = np.unique(code, return_inverse=True)
        kept = (known > 0) & ~np.isin(known, stop)
        dealt = [known * m for m in mixers]
        found = []
        for k in distances:
            n = min(run, len(own) - k)
            if n <= 0:
                continue
            x, y = own[:n], own[k : k + n]
            other = (text[:n] == text[k : k + n]) & (x != y) & kept[x] & kept[y]
            x, y = x[other], y[other]
            low, high = np.minimum(x, y), np.maximum(x, y)
            part = ((dealt[0][low] ^ dealt[1][high]) * mixers[0] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
            found.append(part.astype(np.int64) << 2 * code_bits | low << code_bits | high)
        met = np.concatenate([np.empty(0, np.int64), *found])
        met.sort()
        at = np.flatnonzero(np.concatenate([[True], met[1:] != met[:-1]])[: len(met)])
        n = np.diff(np.append(at, len(met))).astype(np.int32)
        met = met[at]
        a, b = (known[met >> shift & (1 << code_bits) - 1] for shift in (code_bits, 0))
        return met >> 2 * code_bits, a, b, n

    def is_dropped(word: bytes, code: int) -> bool:
        return code in stopped or word in long_stop

    def as_lines(data, text, start, length, code) -> Counter:
        found = Counter()
        for k in distances:
            n = min(run, len(code) - k)
            if n <= 0:
                continue
            here = np.flatnonzero((text[:n] == text[k : k + n]) & ((code[:n] == 0) | (code[k : k + n] == 0)))
            for i in here.tolist():
                x, y = (data[start[j] : start[j] + length[j]].tobytes() for j in (i, i + k))
                if x != y and not is_dropped(x, int(code[i])) and not is_dropped(y, int(code[i + k])):
                    found[min(x, y) + b" " + max(x, y)] += 1
        return found

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, begins in slices(batch.column(0)):
                words = cut(data, begins)
                for at in range(0, len(words[0]), run):
                    text, start, length, code = (w[at : at + run + reach] for w in words)
                    part, a, b, n = as_numbers(text, code)
                    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])[: len(part)])
                    ends = np.append(starts[1:], len(part))[: len(starts)]
                    cells = {int(part[i]): [v[i:j].tobytes() for v in (a, b, n)] + [b""] for i, j in zip(starts.tolist(), ends.tolist())}
                    lines: dict[int, list[bytes]] = {}
                    for pair, times in as_lines(data, text, start, length, code).items():
                        lines.setdefault(zlib.crc32(pair) % parts, []).append(b"%s %d" % (pair, times))
                    for p, some in lines.items():
                        cells.setdefault(p, [b""] * 4)[3] = b"\n".join(some) + b"\n"
                    columns = [list(c) for c in zip(*cells.values())] or [[]] * 4
                    yield pa.RecordBatch.from_arrays([pa.array([*cells], pa.int32()), *[pa.array(c, pa.binary()) for c in columns]], ["part", "a", "b", "n", "long"])

    return form


def _adder(emit: str):
    """Task function: the different pairs of a part with their counts, both
    ways round (``pairs``), or the number of them at each word (``ends``)."""
    short = 12

    def named(code: np.ndarray) -> pa.Array:
        spelled = (code[:, None] >> np.arange(5 * (short - 1), -1, -5, dtype=np.uint64)).astype(np.uint8) & 31
        spelled += np.where(spelled > 0, np.uint8(96), np.uint8(0))
        return pa.array(np.ascontiguousarray(spelled).view(f"S{short}").ravel(), pa.binary()).cast(pa.string())

    def add(part: pa.Table) -> pa.Table:
        held = {c: part.column(c).to_pylist() for c in ("a", "b", "n", "long")}
        a, b = (np.frombuffer(b"".join(held[c]), np.uint64) for c in ("a", "b"))
        known, code = np.unique(np.concatenate([a, b]), return_inverse=True)
        met = code[: len(a)] * max(len(known), 1) + code[len(a) :]
        order = None if emit == "ends" else np.argsort(met)
        met = np.sort(met) if order is None else met[order]
        at = np.flatnonzero(np.concatenate([[True], met[1:] != met[:-1]])[: len(met)])
        x, y = met[at] // max(len(known), 1), met[at] % max(len(known), 1)
        lines = Counter()
        fields = b"".join(held["long"]).decode().split()
        for first, second, times in zip(fields[0::3], fields[1::3], fields[2::3]):
            lines[first, second] += int(times)
        if emit == "ends":
            ends = np.bincount(x, minlength=len(known)) + np.bincount(y, minlength=len(known))
            others = Counter(word for pair in lines for word in pair)
            words = pa.concat_arrays([named(known), pa.array([*others], pa.string())])
            return pa.table({"word": words, "n": pa.concat_arrays([pa.array(ends, pa.int64()), pa.array([*others.values()], pa.int64())])})
        n = np.frombuffer(b"".join(held["n"]), np.int32).astype(np.int64)[order]
        n = np.add.reduceat(n, at) if len(at) else n
        words = named(known)
        first, second = words.take(pa.array(x)), words.take(pa.array(y))
        more = [pa.array([pair[i] for pair in lines], pa.string()) for i in (0, 1)]
        count = [pa.array(n, pa.int64()), pa.array([*lines.values()], pa.int64())]
        return pa.table({
            "term": pa.concat_arrays([first, more[0], second, more[1]]),
            "feature": pa.concat_arrays([second, more[1], first, more[0]]),
            "n": pa.concat_arrays(count * 2),
        })

    return add


def _parts(docs: DataFrame, text: str | Column, distances: Sequence[int], dropped: Sequence[str] = (), least: int = 1) -> DataFrame:
    text = F.col(text) if isinstance(text, str) else text
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(2 * shuffle_width(docs.sparkSession), min(size // PART, _PARTS - 1))
    form = _former(distances, dropped, least, parts, RUN, SLICE)
    return docs.select(F.lower(text).alias("text")).where("text IS NOT NULL").mapInArrow(form, "part int, a binary, b binary, n binary, long binary")


def near_pairs(docs: DataFrame, text: str | Column, reach: int, dropped: Sequence[str] = ()) -> DataFrame:
    """``(term, feature, n)``, both ways round: how often two different words,
    none of them ``dropped``, stand up to ``reach`` places apart."""
    return _parts(docs, text, range(1, reach + 1), dropped).groupBy("part").applyInArrow(_adder("pairs"), "term string, feature string, n bigint")


def near_words(docs: DataFrame, text: str | Column, n: int) -> DataFrame:
    """``(word, neighbours)``: how many different words stand less than ``n``
    places from a word, in texts of at least ``n`` words."""
    ends = _parts(docs, text, range(1, n), least=n).groupBy("part").applyInArrow(_adder("ends"), "word string, n bigint")
    return ends.groupBy("word").agg(F.sum("n").alias("neighbours"))
