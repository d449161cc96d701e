"""Prefix trie of conversations: every shared opening once, with its counts.

A turn is the MD5 of its role and text; a conversation is its turn ids one
after another, 16 bytes each, so the bytes' order is the order of sequences
and a prefix of d turns is a prefix of 16 d bytes.

1. Equal conversations become one sequence with its number of members.
2. Burst trie: all sequences start in the container of the root. A container
   of more than ``CONTAINER`` sequences bursts where they part: the turns they
   all share become trie nodes, sequences that end there stay with the last of
   them, the others move to containers by their next turn id. This is repeated
   until no container is too large; each round parts every container that is,
   however long its shared opening, and is written to shared storage.
3. The containers that remain are dealt out by head, sorted by sequence and
   swept: a task keeps the open path only and gives each node when the sweep
   leaves it. Children wait for their parent's smallest member, so at most one
   container's nodes wait.
4. Burst heads add up what their containers and their own ends give. Counts go
   straight to all heads above, summed map-side; no level waits for another.

The digest of a node's ends needs the member ids in order. They are
range-partitioned by sequence and id and written as runs of text; then each
sequence's runs, far fewer than its members, stream through one hash.

Cases: a null conv_id belongs to no conversation and is left out. Null role or
text is empty. Rows of equal conv_id and turn stand in the order of role and
MD5; a repeated row is a turn of its own. No rows give no nodes; else there is
a root, of depth 0. Other columns are not read. One conversation travels as
one row, of 20 bytes a turn, whatever the length of its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import stored

CONTAINER = 250  # sequences that a container holds before it bursts
_ID = 16  # bytes of a turn id
_RUN = 4096  # member ids in one run of text
_NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def turn_lists(turns: DataFrame) -> DataFrame:
    """``conv_id, turns`` (``id`` in hex and ``chars`` of each, in order) from
    rows ``conv_id, turn, role, text``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").alias("turn"), role.alias("role"),
            F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)).alias("id"),
            F.char_length(text).alias("chars"),
        ).alias("t"),
    )
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return lists.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars"))).alias("turns"))


def share_openings(lists: DataFrame, base: Column, shared: Column, most: int) -> DataFrame:
    """Every conversation with its first ``shared`` turns (``most`` at the
    highest) taken from the conversation ``base`` instead; both are columns of
    ``conv_id``."""
    lists = stored(lists)
    bases = lists.where(F.col("conv_id") == base).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("opening"))
    rows = lists.withColumns({"base": base, "shared": shared.cast("int")}).join(bases, "base", "left")
    none = F.slice("turns", 1, 0)
    opening = F.slice(F.coalesce("opening", none), F.lit(1), F.col("shared"))
    rest = F.slice("turns", F.col("shared") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return rows.select("conv_id", F.concat(opening, rest).alias("turns"))


def _prefix(seq: str, depth: Column) -> Column:
    return F.substring(F.col(seq), F.lit(1), (depth * _ID).cast("int"))


def _runs(size: int):
    """Sorted ``seq, conv_id`` rows as runs of ``size`` comma-joined ids."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def run() -> pa.RecordBatch:
            return pa.record_batch({"seq": pa.array([key], pa.binary()), "first": pa.array([ids[0]], pa.int64()), "ids": pa.array([",".join(map(str, ids))])})

        for batch in batches:
            for seq, conv_id in zip(batch.column("seq").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (seq != key or len(ids) == size):
                    yield run()
                    ids = []
                key = seq
                ids.append(conv_id)
        if ids:
            yield run()

    return runs


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the runs of each sequence, in their order."""
    key, digest = None, None
    for batch in batches:
        out = []
        for seq, ids in zip(batch.column("seq").to_pylist(), batch.column("ids").to_pylist()):
            if digest is None or seq != key:
                if digest is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = seq, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.record_batch({"seq": pa.array([k for k, _ in out], pa.binary()), "ends": pa.array([d for _, d in out], pa.string())})
    if digest is not None:
        yield pa.record_batch({"seq": pa.array([key], pa.binary()), "ends": pa.array([digest.hexdigest()])})


def _sequences(lists: DataFrame) -> DataFrame:
    """``seq, chars, n, conv, ends`` of every different conversation."""
    ids = F.array_join(F.transform("turns", lambda t: t["id"]), "")
    rows = stored(lists.select("conv_id", F.unhex(ids).alias("seq"), F.transform("turns", lambda t: t["chars"]).alias("chars")))
    found = rows.groupBy("seq", "chars").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv"))
    sorted_ids = rows.select("seq", "conv_id").repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    runs = sorted_ids.mapInArrow(_runs(_RUN), "seq binary, first bigint, ids string")
    ends = runs.repartition("seq").sortWithinPartitions("seq", "first").select("seq", "ids").mapInArrow(_digests, "seq binary, ends string")
    return stored(found.join(ends, "seq"))


class _Node:
    __slots__ = ("depth", "chars", "n", "conv", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, depth: int, chars: int):
        self.depth, self.chars = depth, chars
        self.n = self.children = self.leaves = self.saved = 0
        self.conv, self.ends, self.waiting = None, None, []

    def take(self, n: int, conv: int) -> None:
        self.n += n
        self.conv = conv if self.conv is None else min(self.conv, conv)

    def close(self) -> None:
        self.leaves = self.leaves or 1
        self.saved += (self.n - 1) * self.chars

    def row(self, parent: int | None) -> tuple:
        return self.conv, self.depth, parent, self.n, self.children, self.leaves, self.saved, self.ends or _NO_MEMBERS


_NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
_FIELDS = [f.split()[0] for f in _NODE.split(", ")]
_SWEPT = pa.schema([*((c, pa.int64()) for c in _FIELDS[:-1]), ("ends_sha256", pa.string()), ("head", pa.binary()), ("head_chars", pa.list_(pa.int32()))])


def _shared_turns(a: bytes, b: bytes) -> int:
    n = 0
    while a[n : n + _ID] == b[n : n + _ID] and n < min(len(a), len(b)):
        n += _ID
    return n // _ID


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose sequences come sorted by head and sequence.
    The row of a container's head holds the head's bytes; its parent is not
    known here."""
    head, last, chars_of = None, b"", []
    path: list[_Node] = []  # open nodes, the head first
    out: list[tuple] = []

    def leave(depth: int) -> None:
        while path and path[-1].depth > depth:
            node = path.pop()
            node.close()
            out.extend((*child.row(node.conv), None, None) for child in node.waiting)
            if path:
                above = path[-1]
                above.take(node.n, node.conv)
                above.children += 1
                above.leaves += node.leaves
                above.saved += node.saved
                node.waiting = []
                above.waiting.append(node)
            else:
                out.append((*node.row(None), head[1], chars_of[: node.depth]))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _SWEPT)], schema=_SWEPT)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("head_depth", "seq", "chars", "n", "conv", "ends")]
        for head_depth, seq, chars, n, conv, ends in zip(*columns):
            own = (head_depth, seq[: head_depth * _ID])
            if own != head:
                leave(-1)
                head, chars_of = own, chars
                path.append(_Node(head_depth, chars[head_depth - 1] if head_depth else 0))
            else:
                leave(_shared_turns(last, seq))
            for depth in range(path[-1].depth + 1, len(chars) + 1):
                path.append(_Node(depth, chars[depth - 1]))
            path[-1].take(n, conv)
            path[-1].ends = ends
            last = seq
            if len(out) >= 10_000:
                yield batch_of(out)
                out.clear()
    leave(-1)
    if out:
        yield batch_of(out)


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where the sequences of a container part: the turns that its first and
    its last sequence share."""
    for batch in batches:
        ends = zip(batch.column("low").to_pylist(), batch.column("high").to_pylist())
        yield pa.record_batch([batch.column("head_depth"), batch.column("head"), pa.array([_shared_turns(a, b) for a, b in ends], pa.int32())], names=["head_depth", "head", "branch"])


def _burst(sequences: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Containers' sequences with their ``head_depth``, and the sequences that
    end at a burst head (None if nothing burst)."""
    settled, ended, live = None, None, sequences.withColumn("head_depth", F.lit(0))
    while True:
        rows = live.withColumn("head", _prefix("seq", F.col("head_depth")))
        held = rows.groupBy("head_depth", "head").agg(F.count("*").alias("held"), F.min("seq").alias("low"), F.max("seq").alias("high"))
        large = held.where(F.col("held") > CONTAINER).select("head_depth", "head", "low", "high")
        large = stored(large.mapInArrow(_branch, "head_depth int, head binary, branch int"))
        if large.isEmpty():
            return (live if settled is None else settled.unionByName(live)), ended
        rows = stored(rows.join(large, ["head_depth", "head"], "left").drop("head"))
        stay = rows.where("branch IS NULL").drop("branch")
        settled = stay if settled is None else settled.unionByName(stay)
        ends = rows.where(F.size("chars") == F.col("branch")).drop("branch", "head_depth")
        ended = ends if ended is None else ended.unionByName(ends)
        live = rows.where(F.size("chars") > F.col("branch")).withColumn("head_depth", F.col("branch") + 1).drop("branch")


def nodes(lists: DataFrame) -> DataFrame:
    """One row per trie node of ``conv_id, turns`` (as ``turn_lists`` gives
    them): ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``."""
    settled, ended = _burst(_sequences(lists))
    dealt = settled.repartition("head_depth", _prefix("seq", F.col("head_depth"))).sortWithinPartitions("head_depth", "seq")
    swept = dealt.select("head_depth", "seq", "chars", "n", "conv", "ends").mapInArrow(_sweep, f"{_NODE}, head binary, head_chars array<int>")
    if ended is None:
        return swept.select(_FIELDS)
    swept = stored(swept)
    inner, heads = swept.where("head IS NULL").select(_FIELDS), swept.where("head IS NOT NULL")

    # what containers and ends give to the burst heads on their way up
    given = heads.select(
        F.col("head").alias("seq"), F.col("head_chars").alias("chars"), F.col("n_convs").alias("n"), F.col("conv_id").alias("conv"),
        F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"), F.lit(None).cast("string").alias("ends"),
        (F.size("head_chars") - 1).alias("from"), F.lit(1).alias("child"),
    )
    at_head = ended.select("seq", "chars", "n", "conv", F.lit(0).alias("leaves"), F.lit(0).alias("saved"), "ends", F.size("chars").alias("from"), F.lit(0).alias("child"))
    up = given.unionByName(at_head).withColumn("depth", F.explode(F.sequence(F.lit(0), F.col("from"))))
    own = F.col("depth") == F.col("from")
    burst = up.groupBy(_prefix("seq", F.col("depth")).alias("key"), F.col("depth").cast("long").alias("depth")).agg(
        F.sum("n").alias("n"), F.min("conv").alias("conv"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        F.sum(F.when(own, F.col("child")).otherwise(0)).alias("children"), F.max(F.when(own, F.col("ends"))).alias("ends"),
        F.max(F.slice("chars", 1, F.col("depth"))).alias("chars"),
    )
    burst = stored(burst)
    # heads give their own saving to all heads above, and a child to the one above
    rise = burst.withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("depth"))))
    last = F.coalesce(F.get("chars", (F.col("depth") - 1).cast("int")), F.lit(0))
    more = rise.groupBy(_prefix("key", F.col("to")).alias("key"), F.col("to").alias("depth")).agg(
        F.sum((F.col("n") - 1) * F.when(F.col("depth") > 0, last).otherwise(0)).alias("more_saved"),
        F.sum((F.col("to") == F.col("depth") - 1).cast("long")).alias("more_children"),
    )
    above = burst.select(F.col("key").alias("above"), F.col("depth").alias("above_depth"), F.col("conv").alias("parent_conv_id"))

    def with_parent(df: DataFrame, key: str) -> DataFrame:
        df = df.withColumns({"above_depth": F.col("depth") - 1, "above": _prefix(key, F.greatest(F.col("depth") - 1, F.lit(0)))})
        return df.join(above, ["above", "above_depth"], "left").select(_FIELDS)

    burst_rows = burst.join(more, ["key", "depth"]).select(
        "key", F.col("conv").alias("conv_id"), "depth", F.col("n").alias("n_convs"), (F.col("children") + F.col("more_children")).alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("saved") + F.col("more_saved")).alias("saved_tokens"), F.coalesce("ends", F.lit(_NO_MEMBERS)).alias("ends_sha256"),
    )
    return inner.unionByName(with_parent(heads.drop("parent_conv_id"), "head")).unionByName(with_parent(burst_rows, "key"))


_CRC = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))))"""
ORACLE_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text)) AS t,
    any_value({_CRC} % 6) AS h
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT own.conv_id, list_concat(list_slice(coalesce(base.t, []), 1, own.h), list_slice(own.t, own.h + 1, len(own.t))) AS t
  FROM own LEFT JOIN own AS base ON base.conv_id = own.conv_id - own.conv_id % 100),
members AS (
  SELECT conv_id, unnest(range(0, len(t) + 1)) AS depth, t FROM rebuilt),
placed AS (
  SELECT conv_id, depth, list_slice(t, 1, depth) AS node, len(t) = depth AS ends,
    CASE WHEN depth = 0 THEN 0 ELSE length(t[depth].text) END AS chars
  FROM members),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM placed GROUP BY node, depth),
kids AS (
  SELECT list_slice(node, 1, depth - 1) AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
leafed AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.node = nodes.node AND kids.depth = nodes.depth),
up AS (
  SELECT *, unnest(range(0, depth + 1)) AS top FROM leafed),
sums AS (
  SELECT list_slice(node, 1, top) AS node, top AS depth, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * chars) AS saved
  FROM up GROUP BY 1, 2)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, a.ends_sha256
FROM leafed a JOIN sums s ON s.node = a.node AND s.depth = a.depth
LEFT JOIN nodes p ON a.depth > 0 AND p.depth = a.depth - 1 AND p.node = list_slice(a.node, 1, a.depth - 1)
"""
