"""Token files and packing against the tokenizers library itself."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from texts import frame, odd_texts
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from millrace.llm import packing, token_file, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
END = 2


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(PATH)
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


def encoded(encode, texts):
    out = []
    for ids, sizes in encode.encode(pa.array(texts, pa.string())):
        out += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    return out


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab'st .,\n\t\r\0\x1c\x85\xa0\u2003 é漢1<|>Zß")), max_size=40), max_size=5))
def test_cut_texts_have_the_library_ids(texts):
    encode = tokens.encoder(PATH)
    assert encoded(encode, texts) == encode._library(texts)


def test_newline_before_other_blanks(library):
    blanks = "\t\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u2003\u2028\u202f\u3000"
    texts = ["a\n\xa0\xa0x", "\n\xa0\xa0x", "a\n\xa0", "\n\xa0", "a\n\xa0\tx", "a\n", "\na", "a\nb\n"]
    texts += [f"{head}\n{b}{c}{tail}" for head in ("", "a", "a b.") for b in blanks for c in ("", *blanks) for tail in ("", "x", ".", "x\ny")]
    for text in texts:  # one by one, so that no other text is looked at with it
        assert encoded(tokens.encoder(PATH), [text]) == [library(text)], repr(text)
    assert encoded(tokens.encoder(PATH), texts) == [library(t) for t in texts]


def test_special_token_and_long_pieces(library):
    encode = tokens.Encoder(PATH)
    texts = ["a <|endoftext|> b<|endoftext|>\n c", "y" * 500 + " z", " ".join("w%d" % i for i in range(3000)), *odd_texts()]
    texts += ["ab" * n + " " + "é" * n for n in range(1, 30)]  # around the longest piece that is kept
    assert encoded(encode, texts) == [library(t) for t in texts] == encoded(encode, texts)


def test_forgets_at_the_limit(library, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 50)
    encode = tokens.Encoder(PATH)
    for start in range(0, 400, 20):
        text = " ".join(f"q{i}" for i in range(start, start + 20))
        assert encoded(encode, [text]) == [library(text)]
        assert len(encode.known) <= 50


def test_known_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "_SLOTS", 9)  # crowded: chains of taken slots
    known, kept = tokens._Known(), {}
    for start in range(0, 450, 90):
        pieces = [("é" * (i % 9) + str(i) * (i % 4 + 1))[:24] for i in range(start, start + 90)]
        keys, size = tokens._keys(pa.array(pieces, pa.large_string()).slice(0))
        assert size.tolist() == [len(p.encode()) for p in pieces]
        fits = size <= 24
        assert (known.find(keys)[fits] == -1).all()
        known.add(keys[:, fits])
        kept |= {p: len(kept) + n for n, p in enumerate(p for p, f in zip(pieces, fits) if f)}
    keys, _ = tokens._keys(pa.array(["x", *kept], pa.large_string()).slice(1))
    assert known.find(keys).tolist() == [*kept.values()] and len(known) == len(kept)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 1, 255, 256, 65535, 65536, 2**24, 2**32 - 1]), max_size=700), min_size=1, max_size=4))
def test_segment_round_trip(documents):
    flat = np.array([i for d in documents for i in d], np.uint32)
    segment = token_file.Segment(token_file.pack(flat, [len(d) for d in documents]))
    assert [segment.document(i).tolist() for i in range(len(documents))] == documents
    some = range(0, len(flat), max(1, len(flat) // 50))
    assert [segment.get(i) for i in some] == [int(flat[i]) for i in some]
    assert segment.span(len(flat) // 3, len(flat)).tolist() == flat[len(flat) // 3 :].tolist()


def test_segment_rejects_other_data():
    with pytest.raises(ValueError):
        token_file.Segment(b"DACX" + bytes(40))


def test_token_file(spark, library):
    texts = odd_texts()
    ids = [None, *range(1, len(texts) - 1), 1]  # a null and a repeated id
    docs = frame(spark, texts, ids)
    got = token_file.read(token_file.write(docs, PATH, END, segment_ids=5000)).collect()
    want, start = [], 0
    order = sorted(range(len(texts)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i] is not None, (texts[i] or "").encode()))
    for i in order:
        found = [*library(texts[i]), END]
        want.append((ids[i], start, len(found), crc(found)))
        start += len(found)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_one_doc_id_in_many_parts(spark, library):
    """A third of all rows under one doc_id, most of them the same text."""
    texts = ["same text of many rows"] * 300 + [f"own text {i}" for i in range(100)] + ["other"] * 500
    ids = [7] * 400 + [*range(1000, 1500)]
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    written = token_file.write(frame(spark, texts, ids), PATH, END, segment_ids=50)
    spark.conf.set(coalesce, "true")
    parts = {r.part for r in written.where("array_contains(doc_ids, 7)").select("part").distinct().collect()}
    assert len(parts) > 1
    got = sorted(token_file.read(written).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(ids) and got[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    want = sorted((i, len(library(t)) + 1, crc([*library(t), END])) for i, t in zip(ids, texts))
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want


def test_token_file_of_nothing(spark):
    assert token_file.read(token_file.write(frame(spark, []), PATH, END)).count() == 0


def test_cut():
    assert packing.cut(5, 10) == [(0, 5)]
    assert packing.cut(20, 10) == [(0, 10), (10, 10)]
    assert packing.cut(23, 10) == [(0, 3), (3, 10), (13, 10)]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=12))
def test_plan_places_each_piece_once(counts):
    runs, n = packing.plan(counts, 30)
    seen, used = defaultdict(list), defaultdict(list)
    for length, low, high, first, offset in runs.tolist():
        seen[length] += range(low, high)
        for i in range(high - low):
            used[first + i].append((offset, length))
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(v)) for k, v in counts.items()}
    assert sorted(used) == list(range(n))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 30
    # no worse than first-fit decreasing
    bins: list[int] = []
    for length in sorted((k for k, v in counts.items() for _ in range(v)), reverse=True):
        at = next((i for i, b in enumerate(bins) if b + length <= 30), None)
        if at is None:
            bins.append(length)
        else:
            bins[at] += length
    assert n <= len(bins) + 1


def test_pack(spark, library):
    texts = odd_texts()
    ids = [None, *range(1, len(texts) - 1), 1]
    rows = packing.pack(frame(spark, texts, ids), PATH, END).collect()
    whole = defaultdict(int)
    for i, t in zip(ids, texts):
        whole[i] += len(library(t)) + 1
    got = defaultdict(int)
    sequences = defaultdict(list)
    for r in rows:
        got[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == whole
    for spans in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(spans)])]
        assert [o for o, _ in sorted(spans)] == ends[:-1] and ends[-1] <= packing.CAPACITY
    assert len(sequences) <= -(-sum(whole.values()) // packing.CAPACITY) + 1
    by_id = {i: [*library(t), END] for i, t in zip(ids, texts)}
    for r in rows:
        if r.doc_id not in (None, 1):
            assert r.ids_crc32 == crc(by_id[r.doc_id][r.start : r.start + r.length])


def test_pack_of_equal_rows(spark):
    rows = packing.pack(frame(spark, ["the same short text"] * 700, [3] * 700), PATH, END).collect()
    spans = defaultdict(list)
    for r in rows:
        spans[r.sequence_id].append((r.offset, r.length))
    assert len(rows) == 700
    for s in spans.values():
        ends = [0, *np.cumsum([n for _, n in sorted(s)])]
        assert [o for o, _ in sorted(s)] == ends[:-1] and ends[-1] <= packing.CAPACITY


def test_pack_nothing(spark):
    assert packing.pack(frame(spark, []), PATH, END).count() == 0
