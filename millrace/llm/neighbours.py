"""Approximate nearest neighbours by cosine, through a hierarchical k-means tree.

The head of the tree is fitted on at most ``FIT_ROWS`` rows (those of the
smallest vec_id hash) and sent to the tasks; every row is then put into its
leaf. A leaf of more than ``LEAF_LIMIT`` rows is cut again where its rows are:
k-means on at most ``LEAF_FIT`` of them, then its rows go to the children.
This is repeated until no leaf is larger, so that leaves stay bounded however
many rows there are; the centres below the head stay in a table and meet
their leaf's rows and queries in bounded blocks.

A query walks the head best bin first: a priority queue of nodes by nearness
of their centre, so leaves come out in the order they promise to help. Below,
the children of all its leaves are one queue, level by level. How many leaves
are visited is calibrated for each level: up to ``CALIBRATION`` queries get
their true neighbours, without their own row, by brute force over all rows,
and the visits grow until those leaves hold the wanted share of them, in the
end ``RECALL``. A walk goes on until its leaves also hold enough rows.

A leaf's rows and its queries are dealt over blocks of bounded size and meet
block by block. Of equal vectors only the ``k + 1`` of smallest vec_id can
ever be among a query's nearest, so further copies are dropped, map-side
first, and equal query vectors are searched once. Neither changes a result.

Scores are computed in double precision on the original vectors; equal
vectors get equal scores.

Cases: vectors that are null, zero, or hold null or non-finite components
take no part, nor do rows without vec_id or of a length other than the most
frequent one (the shorter on a tie). Rows of one vec_id are one row: equal
ones by nature, of different vectors the one of smallest hash. Ties go to the smaller vec_id. With k or fewer candidates all are returned.
No usable row gives no rows. Columns other than vec_id and embedding are not
read.
"""

from __future__ import annotations

import heapq
import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import discard, stored

_log = logging.getLogger(__name__)

FIT_ROWS = 20_000
LEAF_ROWS = 512  # sampled rows below which a node is not cut again
BRANCHES = 8
CALIBRATION = 256
RECALL = 0.97
LEAF_LIMIT = 16_384  # rows of a leaf beyond which it is cut again
LEAF_FIT = 4_096
FAN = 32  # children of such a leaf at most
BLOCK = 4_096
AT_ONCE = 256  # queries a task works on at a time


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Tree:
    """``centres`` of all nodes; ``children`` of inner nodes; ``leaf`` number
    of a node, or -1."""

    def __init__(self, x: np.ndarray, branches: int = BRANCHES, leaf_rows: int = LEAF_ROWS, seed: int = 3):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        self.n_leaves = 0
        random = np.random.default_rng(seed)
        self._grow(x, x.mean(0), branches, leaf_rows, random)
        self.matrix = np.stack(self.centres)
        # node of each leaf
        self.nodes = np.argsort([n if n >= 0 else len(self.leaf) for n in self.leaf], kind="stable")[: self.n_leaves]

    def _grow(self, x: np.ndarray, centre: np.ndarray, branches: int, leaf_rows: int, random: np.random.Generator) -> int:
        node = len(self.centres)
        self.centres.append(centre / max(np.linalg.norm(centre), 1e-12))
        self.children.append([])
        self.leaf.append(-1)
        parts = self._split(x, branches, random) if len(x) > leaf_rows else []
        if len(parts) < 2:
            self.leaf[node] = self.n_leaves
            self.n_leaves += 1
        else:
            self.children[node] = [self._grow(p, p.mean(0), branches, leaf_rows, random) for p in parts]
        return node

    @staticmethod
    def _split(x: np.ndarray, branches: int, random: np.random.Generator) -> list[np.ndarray]:
        different = np.unique(x, axis=0)
        if len(different) < 2:
            return []
        centres = different[random.choice(len(different), min(branches, len(different)), replace=False)]
        for _ in range(8):
            mine = (x @ centres.T).argmax(1)
            used = np.unique(mine)
            centres = np.stack([x[mine == c].mean(0) for c in used])
            centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        mine = (x @ centres.T).argmax(1)
        return [x[mine == c] for c in np.unique(mine)]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row, down the nearest centres."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
            elif len(rows):
                below = self.children[node]
                mine = (x[rows] @ self.matrix[below].T).argmax(1)
                todo += [(c, rows[mine == i]) for i, c in enumerate(below)]
        return out

    def walk(self, near: np.ndarray, sizes: np.ndarray, visits: int, rows: int) -> list[int]:
        """Leaves in best-bin-first order, until ``visits`` leaves with at
        least ``rows`` rows; ``near`` is the query's nearness to every node."""
        queue, out, held = [(-near[0], 0)], [], 0
        while queue and (len(out) < visits or held < rows):
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
                held += int(sizes[self.leaf[node]])
            for c in self.children[node]:
                heapq.heappush(queue, (-near[c], c))
        return out


def best(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """``(query number, id, score)`` of each query's k best rows."""
    return [(at + q, i, s) for at in range(0, len(queries), AT_ONCE) for q, i, s in _best(queries[at : at + AT_ONCE], rows, ids, k)]


def _best(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    rough = _unit(queries) @ _unit(rows).T
    n = min(k, len(rows))
    cut = np.partition(rough, len(rows) - n, axis=1)[:, len(rows) - n] - 1e-9
    q, r = np.nonzero(rough >= cut[:, None])
    # row by row in one order of summation, so equal vectors get equal scores
    lengths = np.sqrt((queries * queries).sum(1)), np.sqrt((rows * rows).sum(1))
    score = (queries[q] * rows[r]).sum(1) / (lengths[0][q] * lengths[1][r])
    order = np.lexsort((ids[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    top = place < k
    return list(zip(q[top].tolist(), ids[r][top].tolist(), score[top].tolist()))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of the rows that take part, ``v`` in double precision."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(~bad & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    return rows.where(F.size("v") == (common["size"] if common else 0))


def _same() -> list[Column]:
    return [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), "v").alias("h2")]


def _one_per_id(rows: DataFrame) -> DataFrame:
    """Rows with the hashes of their vector; of rows with one vec_id, one."""
    first = Window.partitionBy("vec_id").orderBy("h1", "h2")
    return rows.select("vec_id", "v", *_same()).withColumn("n", F.row_number().over(first)).where(F.col("n") == 1).drop("n")


def _place_all(rows: DataFrame, tree: Tree) -> tuple[DataFrame, list[DataFrame]]:
    """Rows with their final leaf, and the centres ``leaf, child, centre`` of
    each level below the head. Every level makes ``leaf`` out of ``leaf * FAN
    + child``; a leaf that is not cut has the one child 0."""

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield frame.assign(leaf=tree.leaves(_unit(_matrix(frame["v"]))).astype(np.int64))

    def fit(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        x = _unit(_matrix(frame["v"]))
        parts = Tree._split(x, FAN, np.random.default_rng(3))
        centres = [(c := p.mean(0)) / max(np.linalg.norm(c), 1e-12) for p in parts] if len(parts) > 1 else []
        return pd.DataFrame([(key[0], i, c.tolist()) for i, c in enumerate(centres)], columns=["leaf", "child", "centre"])

    def into(block: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if not len(block):
            return pd.DataFrame({"vec_id": [], "v": [], "leaf": []}, dtype=object)
        child = 0
        if len(centres):
            centres = centres.sort_values("child")
            child = (_unit(_matrix(block["v"])) @ _matrix(centres["centre"]).T).argmax(1)
        return pd.DataFrame({"vec_id": block["vec_id"], "v": block["v"], "leaf": block["leaf"] * FAN + child})

    placed, levels = stored(rows.mapInPandas(place, "vec_id bigint, v array<double>, leaf bigint")), []
    order = Window.partitionBy("leaf").orderBy(F.xxhash64("vec_id"), "vec_id")
    while True:
        large = placed.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > LEAF_LIMIT)
        large = stored(large.select("leaf", F.ceil(F.col("n") / BLOCK).alias("blocks")))
        if large.isEmpty():
            return placed, levels
        some = placed.join(large, "leaf").withColumn("n", F.row_number().over(order)).where(F.col("n") <= LEAF_FIT)
        centres = stored(some.select("leaf", "v").groupBy("leaf").applyInPandas(fit, "leaf bigint, child int, centre array<double>"))
        if centres.isEmpty():  # only rows of one direction
            return placed, levels
        # rows of a large leaf come in blocks, its centres once to each
        dealt = placed.join(large, "leaf", "left").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.coalesce("blocks", F.lit(1))).cast("int"))
        to_blocks = centres.join(large, "leaf").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
        left = dealt.where("blocks IS NOT NULL").select("leaf", "block", "vec_id", "v").groupBy("leaf", "block")
        moved = left.cogroup(to_blocks.select("leaf", "block", "child", "centre").groupBy("leaf", "block")).applyInPandas(into, "vec_id bigint, v array<double>, leaf bigint")
        stay = dealt.where("blocks IS NULL").select("vec_id", "v", (F.col("leaf") * FAN).alias("leaf"))
        older, placed = placed, stored(moved.unionByName(stay))
        discard(older)
        levels.append(centres)


def _below(probes: DataFrame, centres: DataFrame, classes: DataFrame) -> DataFrame:
    """``class, leaf, near`` of all children of the leaves in ``probes``
    (``class, leaf, near``)."""

    def look(block: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if not len(block):
            return pd.DataFrame({"class": [], "leaf": [], "near": []})
        if not len(centres):
            return pd.DataFrame({"class": block["class"], "leaf": block["leaf"] * FAN, "near": block["near"]})
        near = _unit(_matrix(block["v"])) @ _matrix(centres.sort_values("child")["centre"]).T
        leaf = (block["leaf"].to_numpy() * FAN)[:, None] + np.arange(near.shape[1])
        return pd.DataFrame({"class": np.repeat(block["class"].to_numpy(), near.shape[1]), "leaf": leaf.ravel(), "near": near.ravel()})

    asked = probes.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = probes.join(classes.select("class", "v"), "class").join(asked, "leaf").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    sent = centres.join(asked, "leaf").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    left = dealt.select("leaf", "block", "class", "v", "near").groupBy("leaf", "block")
    right = sent.select("leaf", "block", "child", "centre").groupBy("leaf", "block")
    return left.cogroup(right).applyInPandas(look, "class bigint, leaf bigint, near double")


def _first(children: DataFrame, sizes: DataFrame, visits: int, rows: int) -> DataFrame:
    """The ``visits`` leaves nearest to each query, and more until they hold
    ``rows`` rows; the place in that order is ``at``."""
    order = Window.partitionBy("class").orderBy(F.desc("near"), "leaf")
    held = children.join(sizes, "leaf")  # a child may have no rows
    placed = held.withColumns({"at": F.row_number().over(order), "before": F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))})
    return placed.where((F.col("at") <= visits) | (F.coalesce("before", F.lit(0)) < rows)).select("class", "leaf", "near", "at")


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the rows for which ``is_query``."""
    spark = vectors.sparkSession
    hashed = _one_per_id(usable(vectors))
    copies = Window.partitionBy("h1", "h2").orderBy("vec_id")
    kept = hashed.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).select("vec_id", "v")
    order = F.xxhash64("vec_id")
    sample = kept.orderBy(order, "vec_id").limit(FIT_ROWS).toPandas()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if not len(sample):
        return empty
    tree = Tree(_unit(_matrix(sample["v"])))
    placed, levels = _place_all(kept, tree)
    below = FAN ** len(levels)
    sizes = stored(placed.groupBy("leaf").agg(F.count("*").alias("n")))
    top = np.zeros(tree.n_leaves, np.int64)  # as many rows as leaves of the head, bounded by the sample
    for r in sizes.groupBy(F.floor(F.col("leaf") / below).alias("leaf")).agg(F.sum("n").alias("n")).collect():
        top[r["leaf"]] = r["n"]

    asked = stored(hashed.where(is_query))
    classes = stored(asked.groupBy("h1", "h2").agg(F.min("vec_id").alias("class"), F.min("v").alias("v")))

    def walked(some: DataFrame, visits: int) -> DataFrame:
        """Leaves of the head for each query, ``class, leaf, near``."""

        def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for at in range(0, len(frame), AT_ONCE):
                    part = frame.iloc[at : at + AT_ONCE]
                    near = _unit(_matrix(part["v"])) @ tree.matrix.T
                    paths = [tree.walk(n, top, visits, k + 1) for n in near]
                    each = [len(p) for p in paths]
                    nearness = [n[tree.nodes[leaf]] for n, path in zip(near, paths) for leaf in path]
                    yield pd.DataFrame({"class": np.repeat(part["class"], each), "leaf": np.concatenate(paths).astype(np.int64), "near": nearness})

        return stored(some.select("class", "v").mapInPandas(walk, "class bigint, leaf bigint, near double"))

    def sizes_at(level: int) -> DataFrame:
        return sizes.groupBy(F.floor(F.col("leaf") / FAN ** (len(levels) - level)).alias("leaf")).agg(F.sum("n").alias("n"))

    some, true = _true_leaves(classes, placed, k)
    wanted = [1 - (1 - RECALL) * (i + 1) / (len(levels) + 1) for i in range(len(levels) + 1)]
    visits = _calibrate(some, true.assign(leaf=true["leaf"] // below), tree, top, wanted[0])
    _log.info("head: %d of %d leaves for %.3f of the true neighbours", visits, tree.n_leaves, wanted[0])
    probes, trial = walked(classes, visits), walked(some, visits) if levels else None
    for level, centres in enumerate(levels, 1):
        held = stored(sizes_at(level))
        # the trial queries tell how many leaves of this level are to be visited
        seen = _first(_below(trial, centres, some), held, (1 << 31) - 1, 0).toPandas()
        visits = _reach(seen, true.assign(leaf=true["leaf"] // FAN ** (len(levels) - level)), wanted[level])
        _log.info("level %d: %d leaves for %.3f of the true neighbours", level, visits, wanted[level])
        trial = stored(_first(_below(trial, centres, some), held, visits, k + 1).drop("at"))
        probes = stored(_first(_below(probes, centres, classes), held, visits, k + 1).drop("at"))
    probes = stored(probes.join(classes.select("class", "v"), "class").select("class", "v", "leaf"))
    asks = probes.groupBy("leaf").agg(F.count("*").alias("asks"))
    shape = stored(sizes.join(asks, "leaf").select("leaf", F.ceil(F.col("n") / BLOCK).alias("row_blocks"), F.ceil(F.col("asks") / BLOCK).alias("query_blocks")))

    def dealt(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        """Rows in their block, once for each block of the other side."""
        spread = df.join(shape, "leaf").withColumn(own, F.pmod(F.xxhash64(key), own).cast("int"))
        return spread.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other).cast("int") - 1)))

    def meet(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(block):
            return pd.DataFrame({"class": [], "vec_id": [], "score": []})
        found = best(_matrix(queries["v"]), _matrix(block["v"]), block["vec_id"].to_numpy(), k + 1)
        names = queries["class"].to_numpy()
        return pd.DataFrame([(names[q], i, s) for q, i, s in found], columns=["class", "vec_id", "score"])

    keys = ["leaf", "row_blocks", "query_blocks"]
    left = dealt(probes, "class", "query_blocks", "row_blocks").groupBy(*keys)
    right = dealt(placed, "vec_id", "row_blocks", "query_blocks").groupBy(*keys)
    met = left.cogroup(right).applyInPandas(meet, "class bigint, vec_id bigint, score double")
    nearest = [F.desc("score"), F.asc("vec_id")]
    best_rows = met.withColumn("n", F.row_number().over(Window.partitionBy("class").orderBy(*nearest))).where(F.col("n") <= k + 1).drop("n")
    names = asked.join(classes.drop("v"), ["h1", "h2"]).select(F.col("vec_id").alias("query_id"), "class")
    pairs = names.join(best_rows, "class").where("vec_id != query_id")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*nearest)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _true_leaves(classes: DataFrame, placed: DataFrame, k: int) -> tuple[DataFrame, pd.DataFrame]:
    """The trial queries ``class, v``, and ``class, leaf`` of their true
    neighbours, by brute force over all rows. A query's own row is none of
    them."""
    some = stored(classes.orderBy(F.xxhash64("class"), "class").limit(CALIBRATION).select("class", "v"))
    few = some.toPandas()
    if not len(few):
        return some, pd.DataFrame({"class": [], "leaf": []}, dtype=np.int64)
    queries, own = _matrix(few["v"]), few["class"].tolist()

    def brute(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                found = best(queries, _matrix(frame["v"]), frame["vec_id"].to_numpy(), k + 1)
                leaf = dict(zip(frame["vec_id"].tolist(), frame["leaf"].tolist()))
                yield pd.DataFrame([(own[q], i, s, leaf[i]) for q, i, s in found if i != own[q]], columns=["class", "vec_id", "score", "leaf"])

    found = placed.mapInPandas(brute, "class bigint, vec_id bigint, score double, leaf bigint")
    order = Window.partitionBy("class").orderBy(F.desc("score"), "vec_id")
    # at most CALIBRATION * k rows
    return some, found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("class", "leaf").toPandas()


def _share(depth: list[int], share: float) -> int:
    return int(np.sort(depth)[int(np.ceil(share * len(depth) - 1e-9)) - 1]) if depth else 1


def _calibrate(some: DataFrame, true: pd.DataFrame, tree: Tree, sizes: np.ndarray, share: float) -> int:
    """Leaves of the head to visit so that they hold ``share`` of the true
    neighbours."""
    few = some.toPandas()  # at most CALIBRATION rows
    if not len(few):
        return 1
    near = dict(zip(few["class"].tolist(), _unit(_matrix(few["v"])) @ tree.matrix.T))
    depth = []
    for q, group in true.groupby("class"):
        at = {leaf: i for i, leaf in enumerate(tree.walk(near[q], sizes, tree.n_leaves, 0))}
        depth += [at[leaf] + 1 for leaf in group["leaf"]]
    return _share(depth, share)


def _reach(seen: pd.DataFrame, true: pd.DataFrame, share: float) -> int:
    """The same for leaves below the head, in the order of ``seen``; leaves
    missed further up count as last."""
    at = {(q, leaf): n for q, leaf, n in zip(seen["class"].tolist(), seen["leaf"].tolist(), seen["at"].tolist())}
    last = max(at.values(), default=1)
    return _share([at.get(x, last) for x in zip(true["class"].tolist(), true["leaf"].tolist())], share)
