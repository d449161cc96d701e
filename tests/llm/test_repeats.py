"""Line, passage, near-copy and benchmark operators against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from texts import ascii_lower, frame, odd_texts, sentence, words

from millrace.llm import components, decontaminate, lines, runindex, simhash, suffix

BLANKS = " \t\n\x0b\x0c\r"


def line_key(line):
    return ascii_lower(line.strip(BLANKS))


@pytest.mark.parametrize("keep_first, per_part", [(False, 3), (True, 3), (True, 1_000_000)])
def test_lines(spark, monkeypatch, keep_first, per_part):
    monkeypatch.setattr(lines, "ROWS_PER_PART", per_part)  # 3: heavy keys are dealt out
    texts = odd_texts()
    ids = [None, *range(1, len(texts))]
    docs = frame(spark, texts, ids)
    split = [(t or "").split("\n") for t in texts]
    held = {}
    for parts in split:
        for key in {line_key(p) for p in parts} - {""}:
            held[key] = held.get(key, 0) + 1
    common = {k for k, n in held.items() if n >= 4}
    assert common
    order = sorted(range(len(texts)), key=lambda i: (ids[i] is not None, ids[i] or 0))
    kept, firsts, seen = {}, {}, set()
    for i in order:
        out, firsts[ids[i]] = [], 0
        for p in split[i]:
            key = line_key(p)
            first = key in common and key not in seen
            if key not in common or (keep_first and first):
                out.append(p)
            firsts[ids[i]] += first
            seen.add(key)
        kept[ids[i]] = (len(split[i]), len(split[i]) - len(out), "\n".join(out))
    found = lines.apply(docs, lines.drop_bitmaps(docs, min_docs=4), keep_first)
    assert {r.doc.doc_id: (r.n_lines, r.n_dropped, r.doc.text) for r in found.collect()} == kept
    assert {r.doc.doc_id: r.n_first for r in found.collect()} == firsts
    assert set(found.select("doc.*").columns) == set(docs.columns)


def test_lines_repeated_rows_and_none(spark):
    docs = frame(spark, ["same\nown"] * 3 + ["other"], [1, 1, 2, 3])
    found = lines.apply(docs, lines.drop_bitmaps(docs, min_docs=3)).collect()
    assert sorted((r.doc.doc_id, r.n_dropped, r.doc.text) for r in found) == [(1, 2, ""), (1, 2, ""), (2, 2, ""), (3, 0, "other")]
    empty = frame(spark, [])
    assert lines.apply(empty, lines.drop_bitmaps(empty)).count() == 0


def brute_print(text):
    parts = [p for p in ascii_lower(text or "").translate({ord(c): " " for c in BLANKS}).split(" ") if p]
    shingles = [" ".join(parts[i : i + 3]) for i in range(max(1, len(parts) - 2))] if parts else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values, bits):
    group = list(range(len(values)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                a, b = sorted((top(i), top(j)))
                group[b] = a
    return [top(i) for i in range(len(values))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("crowd", [0, 3, 1000])
@pytest.mark.parametrize("bits", [1, 2])
def test_simhash_links(spark, monkeypatch, crowd, bits):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(crowd + bits)
    values = {0, 1, 3, 7, 2**64 - 1, 2**63, 2**63 + 1}
    for _ in range(12):
        value = rng.getrandbits(64)
        for _ in range(15):
            values.add(value)
            for _ in range(rng.randint(1, 3)):
                value ^= 1 << rng.randrange(64)
    values = sorted(values)
    prints = spark.createDataFrame([(signed(v),) for v in values], "fp bigint")
    found = {r.node: r.component for r in components.connected(simhash.links(prints, bits)).collect()}
    got = [found.get(signed(v), signed(v)) for v in values]
    want = brute_groups(values, bits)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_near_duplicates(spark):
    texts = odd_texts()
    ids = [*range(10, 10 + len(texts) - 2), 10, None]
    docs = frame(spark, texts, ids)
    prints = [brute_print(t) for t in texts]
    groups = brute_groups(prints, 2)
    first = {}
    for i, g in zip(ids, groups):
        if i is not None:
            first[g] = min(first.get(g, i), i)
    want = sorted(((i, f"{p:016x}", first.get(g)) for i, p, g in zip(ids, prints, groups)), key=str)
    found = simhash.near_duplicates(docs).select("doc_id", simhash.hex_digits("fp").alias("f"), "component_id").collect()
    assert sorted(map(tuple, found), key=str) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(groups))
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_no_cells_or_links_pass_the_driver(spark, monkeypatch):
    plans = []
    for module in (simhash, components):
        keep = module.stored
        monkeypatch.setattr(module, "stored", lambda df, keep=keep: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    monkeypatch.setattr(simhash, "CROWD", 1)
    prints = spark.createDataFrame([(v,) for v in (0, 1, 3, 7, 1 << 40)], "fp bigint")
    assert components.connected(simhash.links(prints)).count() == 5
    assert sum("SortMergeJoin" in p for p in plans) > 3
    assert not any("BroadcastHashJoin" in p for p in plans)


def test_keep_one_of_repeated_rows(spark):
    docs = frame(spark, ["one two three four", "one two three four", None, ""], [5, 5, None, 9])
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()) == [(5, "one two three four"), (9, "")]


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 102), (102, 101), (7, 7)] + [(200, i) for i in range(201, 260)]
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 103)}, **{i: 200 for i in range(200, 260)}}


def brute_windows(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        n = min(10, len(w))
        for i in range(len(w) - n + 1):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for n in range(1, 11):
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    found |= windows[tuple(w[i : i + n])]
                    hit |= set(range(i, i + n))
        out.append((len(w), len(hit), sorted(found)))
    return out


def test_decontamination(spark):
    rng = random.Random(3)
    items = [(i, sentence(rng, rng.randint(8, 30))) for i in range(30)] + [(None, sentence(rng, 15)), (31, None), (32, "--"), (33, "Solo"), (34, "Five words for one item"), (35, "amber bolt amber bolt")]
    items += [(36, items[0][1]), (0, items[1][1])]  # equal texts, repeated id
    texts = [None, "", "solo SOLO", "x five words for one item y"]
    for _ in range(60):
        w = sentence(rng, rng.randint(5, 80)).split()
        for _ in range(rng.randint(0, 3)):
            source = (rng.choice(items)[1] or "").split()
            cut = rng.randint(0, max(0, len(source) - 9))
            at = rng.randint(0, len(w))
            w[at:at] = source[cut : cut + rng.randint(8, 14)]
        texts.append(rng.choice([" ", " - ", "\n"]).join(w).title())
    texts.append(" ".join(t or "" for _, t in items) * 3)
    ids = [None, *range(1, len(texts))]
    docs = frame(spark, texts, ids)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, key int")
    want = {i: w for i, w in zip(ids, brute_windows(texts, items))}
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in decontaminate.find(docs, bench).collect()}
    assert got == want
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, (_, n, _) in want.items() if not n}
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(texts)
    assert decontaminate.find(frame(spark, []), bench).count() == 0


def test_run_index_matches():
    rng = random.Random(5)
    for _ in range(30):
        base = bytes(rng.choice(b"ab\0\xff") for _ in range(40))
        texts = [bytes(base[rng.randrange(10) : rng.randrange(20, 40)]) + bytes(rng.choice(b"ab") for _ in range(rng.randrange(5))) for _ in range(8)]
        owners = np.array([rng.randrange(5) for _ in texts])
        n = rng.choice([3, 6, 12])
        first = {}
        for t, o in zip(texts, owners):
            for i in range(len(t) - n + 1):
                first[t[i : i + n]] = min(first.get(t[i : i + n], 99), o)
        got = {(int(t), int(p)): int(o) for t, p, o in zip(*runindex.first_owner(texts, owners, n))}
        assert got == {(k, i): first[t[i : i + n]] for k, t in enumerate(texts) for i in range(len(t) - n + 1)}


def test_runs_are_fewer_than_letters():
    text = b"the quick brown fox jumps over the lazy dog"
    index = runindex.RunIndex([text] * 50)
    assert index.run_length.sum() == len(index.letters) and len(index.run_letter) < len(index.letters) / 10


def brute_removed(texts, ids):
    first = {}
    late = 1 << 70
    data = [(t or "").encode() for t in texts]
    for b, i in zip(data, ids):
        for p in range(len(b) - 49):
            s = b[p : p + 50]
            first[s] = min(first.get(s, late), late if i is None else i)
    out = []
    for b, i in zip(data, ids):
        gone = np.zeros(len(b) + 2, np.int8)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < (late if i is None else i):
                gone[p + 1 : p + 51] = 1
        kept = bytes(c for c, g in zip(b, gone[1:-1]) if not g)
        out.append((len(b), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("crowd, piece", [(30_000, 1 << 19), (2, 300)])
def test_suffix(spark, monkeypatch, crowd, piece):
    monkeypatch.setattr(suffix, "CROWD", crowd)
    rng = random.Random(11)
    texts = odd_texts()
    shared = sentence(rng, 60)
    for _ in range(60):
        a, b = sorted(rng.sample(range(len(shared)), 2))
        own = sentence(rng, 10)
        texts.append(own[: rng.randrange(60)] + shared[a:b] + rng.choice(["é", "", "\0"]) + own + shared[b - 55 : b] + "q" * rng.randrange(120))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[3] = None
    ids[8] = ids[9]  # two rows of one document
    docs = frame(spark, texts, ids)
    want = sorted(((i, *w) for i, w in zip(ids, brute_removed(texts, ids))), key=str)
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in suffix.remove_repeats(docs).collect()]
    assert sorted(got, key=str) == want
    assert suffix.remove_repeats(frame(spark, [])).count() == 0


def test_long_texts_come_in_pieces(monkeypatch):
    rng = random.Random(2)
    text = sentence(rng, 2000).encode()
    whole = {(int(p), int(h), int(c)) for m in suffix.marks([text]) for p, h, c in zip(m.place, m.hash, m.contexts())}
    monkeypatch.setattr(suffix, "_PIECE", 301)
    parts = {(int(p), int(h), int(c)) for m in suffix.marks([text]) for p, h, c in zip(m.place, m.hash, m.contexts())}
    assert parts == whole


def test_suffixes_are_not_compared_beyond_their_texts():
    """Copies that follow one another in the same order would be compared over
    all of them; equal suffixes come in the order of their texts."""
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(1, 40))) for _ in range(30)] * 6
    index = runindex.RunIndex(texts)
    places = [(text, i) for text, data in enumerate(texts) for i in range(len(data) + 1)]
    want = sorted(range(len(places)), key=lambda p: (texts[places[p][0]][places[p][1] :], places[p][0]))
    assert index.order.tolist() == want
    assert max(width for width, _ in index.levels) <= 2 * max(map(len, texts))
    text, place, least = runindex.first_owner(texts, np.arange(len(texts)) // 7, 5)
    first = {}
    for t, data in enumerate(texts):
        for i in range(len(data) - 4):
            first.setdefault(data[i : i + 5], t // 7)
    assert {(t, i): o for t, i, o in zip(text.tolist(), place.tolist(), least.tolist())} == {(t, i): first[texts[t][i : i + 5]] for t, data in enumerate(texts) for i in range(len(data) - 4)}
