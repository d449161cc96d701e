"""Conversation trie against a plain dictionary of prefixes."""

import hashlib
import math
import random
import zlib

import pytest
from check_oracle import connect, difference
from pyspark.sql import functions as F

from millrace.llm import queries, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n string, seq string, depth string, `turns` string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA).repartition(3)


def turn_key(turn, role, text):
    role, text = role or "", text or ""
    return (turn is not None, turn or 0), role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn_key(turn, role, text), (role or "", text or "")))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    shared = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    built = {c: tuple(own.get(c - int(math.fmod(c, 100)), [])[: shared[c]] + t[shared[c] :]) for c, t in own.items()}
    members = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    out = set()

    def below(node):
        leaves, saved = 0, (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        for k in kids.get(node, []):
            a, b = below(k)
            leaves, saved = leaves + a, saved + b
        ends = ",".join(str(c) for c in sorted(members[node]) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.add((min(members[node]), len(node), parent, len(members[node]), len(kids.get(node, [])), leaves or 1, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves or 1, saved

    if members:
        below(())
    return out


def found(spark, rows):
    conv_id = F.col("conv_id")
    lists = trie.turn_lists(conversations(spark, rows))
    got = trie.nodes(trie.share_openings(lists, conv_id - conv_id % 100, F.crc32(conv_id.cast("string").cast("binary")) % 6, 5))
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got))
    return set(got)


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-150, 450), 150):
        for turn in range(rng.choice([1, 2, 3, 3, 4, 7, 9])):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["", "hi", "yes", "größe 😀", "a longer answer"])))
    rows += [(500, t, "user", "deep") for t in range(60)] + [(501, t, "user", "deep") for t in range(61)]
    # a group of copies, also of a turn below the others
    for conv in range(600, 660):
        rows += [(conv, 0, "system", "same"), (conv, 1, "user", "hi"), (conv, 2, "user", "bye")]
    rows += [(700, None, "user", "first"), (700, 3, None, "x"), (700, 3, None, "x"), (700, 3, "a", None), (701, 1, None, None), (None, 0, "user", "nobody")]
    return rows


@pytest.mark.parametrize("container, run", [(1000, 4096), (20, 7), (1, 1)])
def test_nodes(spark, monkeypatch, container, run):
    monkeypatch.setattr(trie, "CONTAINER", container)
    monkeypatch.setattr(trie, "_RUN", run)
    rows = random_rows(container)
    assert found(spark, rows) == brute(rows)


def test_none(spark):
    assert found(spark, []) == set()
    assert found(spark, [(None, 0, "user", "nobody")]) == set()


def test_turnless(spark):
    # 7 shares its opening with a conversation that is absent and keeps nothing of its own
    conv = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(conv, 0, "user", "a")]
    assert found(spark, rows) == brute(rows) == {(conv, 0, None, 1, 0, 1, 0, hashlib.sha256(str(conv).encode()).hexdigest())}


def test_larger_table_bursts(spark, monkeypatch):
    monkeypatch.setattr(trie, "CONTAINER", 50)
    folder = "/root/testdata/sf0.1"
    got = queries.QUERIES["op13_conversation_trie"](spark, folder).toPandas()
    assert difference(got, connect(folder).execute(trie.ORACLE_SQL).fetchdf()) is None
