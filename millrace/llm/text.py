"""Words of whole texts as numpy arrays, for use inside Spark tasks.

Texts arrive as UTF-8 bytes. All bytes of a non-ASCII character are 0x80 or
above, so the byte classes below cut exactly where the character classes do.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_UPPER = range(0x41, 0x5B)
_ALNUM = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_SPACE = {0x20, *range(0x09, 0x0E)}

# lower-cases A-Z; what separates words becomes a blank
WORD_BYTES = bytes(b + 32 if b in _UPPER else b if b in _ALNUM else 0x20 for b in range(256))
# the same with white space as the only separator
SPACED_BYTES = bytes(b + 32 if b in _UPPER else 0x20 if b in _SPACE else b for b in range(256))

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_STEP = 0x5851F42D4C957F2D  # odd, so powers never vanish modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _GOLDEN)


def powers(n: int) -> np.ndarray:
    """``_STEP ** i`` for i below n, modulo 2**64."""
    out = np.full(n, _STEP, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def batches(texts: Sequence[bytes | None], limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """``(index of the first, texts)`` in runs of about ``limit`` bytes; null
    becomes the empty text. A longer text is a run of its own, whole."""
    start, run, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or b""
        if run and size + len(text) > limit:
            yield start, run
            start, run, size = i, [], 0
        run.append(text)
        size += len(text)
    if run:
        yield start, run


class Words:
    """Words of several texts: ``text`` (index of the text), ``start`` and
    ``end`` (byte places in ``data``), ``first`` (first word of each text,
    and the total at the end)."""

    def __init__(self, texts: Sequence[bytes], table: bytes = WORD_BYTES):
        self.data = b" ".join(texts).translate(table)
        codes = np.frombuffer(self.data, np.uint8)
        inside = np.zeros(len(codes) + 2, np.int8)
        inside[1:-1] = codes != 0x20
        edge = np.diff(inside)
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        begins = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.first = np.searchsorted(self.start, begins)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word, the same on every machine and run."""
        size = self.end - self.start
        if not len(size):
            return np.empty(0, np.uint64)
        codes = np.frombuffer(self.data, np.uint8)
        letters = codes[codes != 0x20]
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        place = np.arange(len(letters)) - np.repeat(begin, size)
        terms = _BYTE_CODES[letters] * powers(int(size.max()))[place]
        return mix(np.add.reduceat(terms, begin) + size.astype(np.uint64))

    def same_text(self, span: int) -> np.ndarray:
        """For every word, whether ``span`` words from it lie in its text."""
        n = len(self.start)
        return np.arange(n) + span <= self.first[1:][self.text]


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(_STEP) + words[i : i + n]
    return mix(out)


def sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every run of ``size`` values."""
    n = len(values) - size + 1
    if n <= 0:
        return values[:0]
    out, width = values, 1
    while width * 2 <= size:
        out = pick(out[:-width], out[width:])
        width *= 2
    return pick(out[:n], out[size - width : size - width + n])
