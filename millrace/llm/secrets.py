"""Secrets in whole texts: by form, and by how badly they tokenize.

1. Forms: a value set to a password-like name (``assign``), access keys
   (``access``) and long lower-case hex runs (``hex``); leftmost,
   non-overlapping within each kind.
2. Token efficiency: a run of at least ``SHORTEST`` letters, digits and
   ``+/_=-`` is ``random`` if a tiktoken vocabulary needs so many tokens for it
   that fewer than ``LEAST_RATIO`` characters fall on each. Words of any
   language, and names made of words, give two and a half or more; random
   strings of any alphabet but plain digits give less than two. Left out
   before the test: known digests (hex of a digest's length), UUIDs, and
   numbers, dates and times. A run that overlaps a span of 1 is known already.

Arrow kernels find, in one linear pass each, the few texts in which a kind can
occur at all; only those are searched for places. A long run is counted whole,
in pieces of ``_PIECE`` characters, so that no single piece is costly.

Cases: null is the empty text. Each row is scanned, repeated rows and rows
with a null doc_id too. No rows give no rows. Other columns are not read.
Places are code points, the end not included.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

SHORTEST = 20
LEAST_RATIO = 2.0
_PIECE = 1024

_NAMES = "(password|passwd|secret|token|api_?key)"
_ASSIGN = re.compile(_NAMES + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{32,}")
_RUN = re.compile(f"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
LEAST_VALUE, LEAST_ACCESS = 8, 16
# whether a kind can occur in a text
_CAN = {
    "assign": f"(?i){_NAMES}[\"']? *[:=]",
    "access": "AKIA[A-Z0-9]",
    "hex": "[0-9a-f]{32}",
    "random": f"[A-Za-z0-9+/_=-]{{{SHORTEST}}}",
}
KINDS = [*_CAN]

_DIGEST = re.compile("(?:[0-9a-f]+|[0-9A-F]+)=*")
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}  # MD5, SHA-1 and the SHA-2 family in hex
_UUID = re.compile("[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_NUMBERS = re.compile("[-+/_=]*[0-9]+([-+/_=T]+[0-9]+)*[-+/_=Z]*")

Span = tuple[str, int, int]


def known(run: str) -> bool:
    """A digest, a UUID, or numbers, dates and times."""
    bare = run.strip("-+/_=")
    digest = len(bare) in DIGEST_LENGTHS and _DIGEST.fullmatch(bare)
    return bool(digest or _UUID.fullmatch(bare) or _NUMBERS.fullmatch(run))


class Vocabulary:
    """Characters per token under a tiktoken vocabulary file."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ratio(self, run: str) -> float:
        encode = self.encoding.encode_ordinary
        return len(run) / sum(len(encode(run[i : i + _PIECE])) for i in range(0, len(run), _PIECE))


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The worker's vocabulary of a file."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def spans(text: str, can: set[str], use: Vocabulary) -> list[Span]:
    """Spans of a text in which the kinds ``can`` may occur, by start, then
    kind."""
    out: list[Span] = []
    if "assign" in can:
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "access" in can:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    if "hex" in can:
        out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    if "random" in can:
        taken = sorted((start, end) for _, start, end in out)
        # the furthest end among the spans up to each one
        starts, ends = np.array([s for s, _ in taken], np.int64), np.maximum.accumulate(np.array([e for _, e in taken], np.int64))
        for m in _RUN.finditer(text):
            before = int(np.searchsorted(starts, m.end()))
            if (before and ends[before - 1] > m.start()) or known(m[0]):
                continue
            if use.ratio(m[0]) < LEAST_RATIO:
                out.append(("random", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("spans", _SPANS)])


def scan(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, spans`` (``kind, start, end``) of every row of ``docs``;
    ``path`` is the tiktoken vocabulary file."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = vocabulary(path)
        for batch in batches:
            texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            found: list[list] = [[] for _ in range(len(texts))]
            can = {kind: pc.match_substring_regex(texts, pattern) for kind, pattern in _CAN.items()}
            some = np.logical_or.reduce([c.to_numpy(zero_copy_only=False) for c in can.values()])
            flags = {kind: c.to_pylist() for kind, c in can.items()}
            for i in np.flatnonzero(some).tolist():
                hits = spans(texts[i].as_py(), {kind for kind in KINDS if flags[kind][i]}, use)
                found[i] = [{"kind": k, "start": a, "end": b} for k, a, b in hits]
            yield pa.record_batch([batch.column("doc_id"), pa.array(found, _SPANS)], schema=_SCHEMA)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(search, "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint>>")


def joined(spans: str, base_only: bool):
    """``kind:start:end`` of each span, comma-joined."""
    kept = F.filter(spans, lambda s: s["kind"] != "random") if base_only else F.col(spans)
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
