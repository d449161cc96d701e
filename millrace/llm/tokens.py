"""Token ids of whole texts, from a byte-level tokenizer file of the
tokenizers library.

Such tokenizers never join text across a step from a visible character to
white space, so a text may be cut there and each piece encoded on its own.
The cuts and the list of different pieces of a batch come from Arrow kernels;
the library is asked once for each piece that a worker has not met yet. A
piece of at most 24 bytes, and few are longer, is its own key in a table of
numpy arrays, so that what a worker remembers is small and looked up without
making a Python object. It is bounded; at the limit a worker starts anew.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from millrace.llm.text import mix

KEPT_PIECES = 1_000_000
KEPT_IDS = 1 << 22
_SLOTS = 21  # bits
_KEY_BYTES = 24
_BATCH = 1 << 21  # bytes cut at once
# white space of any kind, by code point
_BLANK = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_WORD = re.compile(f" ?[{_LETTERS}]+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the
    others from code point 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Known:
    """Numbers of the pieces met so far, by open addressing."""

    def __init__(self):
        self.keys = np.zeros((_KEY_BYTES // 8, 1 << _SLOTS), np.uint64)
        self.at = np.full(1 << _SLOTS, -1, np.int32)
        self.used = 0

    def __len__(self) -> int:
        return self.used

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(keys.shape[1], np.uint64)
        for word in keys:
            out = mix(out ^ word)
        return (out & np.uint64(len(self.at) - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, or -1."""
        slot, out = self._slots(keys), np.full(keys.shape[1], -1, np.int32)
        todo = np.arange(len(out))
        while len(todo):
            here = slot[todo]
            at = self.at[here]
            same = at >= 0
            for mine, kept in zip(keys, self.keys):
                same &= kept[here] == mine[todo]
            out[todo[same]] = at[same]
            todo = todo[(at >= 0) & ~same]
            slot[todo] = (slot[todo] + 1) & (len(self.at) - 1)
        return out

    def add(self, keys: np.ndarray) -> None:
        """Give different new keys the next numbers."""
        slot, numbers = self._slots(keys), np.arange(self.used, self.used + keys.shape[1], dtype=np.int32)
        todo = np.arange(len(numbers))
        while len(todo):
            free = todo[self.at[slot[todo]] < 0]
            self.at[slot[free]] = numbers[free]  # of several that want a slot one gets it
            got = free[self.at[slot[free]] == numbers[free]]
            self.keys[:, slot[got]] = keys[:, got]
            todo = np.setdiff1d(todo, got, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & (len(self.at) - 1)
        self.used += len(numbers)


def _keys(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each piece as numbers, zeros after its end, and its size;
    pieces hold no NUL. Longer pieces have a part of their bytes only."""
    _, offsets, data = pieces.buffers()
    offsets = np.frombuffer(offsets, np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
    size = np.diff(offsets)
    data = np.concatenate([np.frombuffer(data or b"", np.uint8), np.zeros(_KEY_BYTES, np.uint8)])
    eight = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))  # the eight bytes from every place on
    cover = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    words = [eight[np.minimum(offsets[:-1] + i, len(eight) - 1)] & cover[np.clip(size - i, 0, 8)] for i in range(0, _KEY_BYTES, 8)]
    return np.stack(words), size


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        kind = json.loads(self.tokenizer.to_str())
        cutter = kind["pre_tokenizer"] or {}
        if kind["normalizer"] or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True):
            raise ValueError("not a plain byte-level tokenizer")
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self._clear()

    def _clear(self) -> None:
        self.known = _Known()
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0
        self.begin = np.zeros(1 << 16, np.int32)
        self.size = np.zeros(1 << 16, np.int32)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and how many each has. A plain
        word is one step of the tokenizer's own cutting and goes straight to
        its model."""
        tokenize, letters, plain = self.model.tokenize, self.letters, _WORD.fullmatch
        blank = letters[0x20]
        ids: list[int] = []
        stops = []
        for piece in new:
            if not plain(piece):
                ids += self._library([piece])[0]
            elif piece.isascii():  # letters stand for themselves
                ids += [t.id for t in tokenize(blank + piece[1:] if piece[0] == " " else piece)]
            else:
                ids += [t.id for t in tokenize(piece.encode().decode("latin-1").translate(letters))]
            stops.append(len(ids))
        return np.array(ids, np.uint32), np.diff(np.array([0, *stops], np.int64))

    def _places(self, different: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Begin and number of the ids of each piece in ``self.ids``."""
        keys, length = _keys(different)
        short = length <= _KEY_BYTES
        at = np.where(short, self.known.find(keys), -1)
        missing = np.flatnonzero(at < 0)
        fresh = missing[short[missing]]
        if len(self.known) + len(fresh) > KEPT_PIECES or self.used > KEPT_IDS:
            self._clear()
            missing = np.arange(len(different))
            at = np.full(len(different), -1)
            fresh = np.flatnonzero(short)[:KEPT_PIECES]
        begin, size = self.begin[at].astype(np.int64), self.size[at].astype(np.int64)
        if len(missing):
            flat, sizes = self._learn(different.take(pa.array(missing)).to_pylist())
            begins = self.used + np.cumsum(sizes) - sizes
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            self.ids[self.used : self.used + len(flat)] = flat
            begin[missing], size[missing] = begins, sizes
            # long pieces are used now and not remembered
            n = len(self.known)
            while n + len(fresh) > len(self.begin):
                self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
            self.begin[n : n + len(fresh)], self.size[n : n + len(fresh)] = begin[fresh], size[fresh]
            self.known.add(keys[:, fresh])
            if len(self.known) > n:
                self.used += len(flat)
        return begin, size

    def _cut(self, texts: pa.Array) -> pa.Array:
        """Lists of the pieces of texts without NUL: cut before white space
        and around newlines between visible characters, and between a letter
        and a mark."""
        marked = pc.replace_substring(pc.replace_substring(texts, "\n", "\0\n\0"), " ", "\0 ")
        # where white space comes in runs, only its first character is cut off from what is before;
        # the tokenizer may keep any of it in one step, such as a newline and the blank after it
        runs = pc.match_substring_regex(texts, f"[{_BLANK}][ \n]|\n[{_BLANK}]")
        if pc.any(runs).as_py():
            once = pc.replace_substring_regex(texts.filter(runs), f"([^{_BLANK}])([ \n])", "\\1\0\\2")
            marked = pc.replace_with_mask(marked, runs, once)
        return pc.split_pattern(pc.replace_substring_regex(marked, "([A-Za-z])([.,!?;:])", "\\1\0\\2"), "\0")

    def _some(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring(texts, "\0")
        if pc.any(odd).as_py():
            parts = [self._some(pa.array([""] if o else [t], pa.large_string())) if not o else (np.array(self._library([t])[0], np.uint32), None) for t, o in zip(texts.to_pylist(), odd.to_pylist())]
            return np.concatenate([ids for ids, _ in parts]), np.array([len(ids) for ids, _ in parts], np.int64)
        lists = self._cut(texts)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        pieces = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        begin, size = self._places(pieces.dictionary)
        at = pieces.indices.to_numpy()
        size = size[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(begin[at] - ends[:-1], size) + np.arange(ends[-1])]
        return ids, np.diff(ends[offsets - offsets[0]])

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids the library gives for each whole text (null: empty), as
        ``(ids of some texts one after another, number of each)``."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _BATCH, "right")))
            # one part at a time is copied
            yield self._some(pc.fill_null(pa.concat_arrays([texts.slice(start, stop - start)]).cast(pa.large_string()), ""))
            start = stop


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def documents(encode: Encoder, texts: pa.Array, end_id: int) -> Iterator[np.ndarray]:
    """Ids of each text, closed by ``end_id``."""
    end = np.array([end_id], np.uint32)
    for ids, sizes in encode.encode(texts):
        stops = np.cumsum(sizes).tolist()
        start = 0
        for stop in stops:
            yield np.concatenate([ids[start:stop], end])
            start = stop
