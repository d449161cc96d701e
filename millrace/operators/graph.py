"""Graph statistics and PageRank over ``edges(src, dst, weight)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.hashing import key_hash
from millrace.operators.counting import top_n
from millrace.operators.sampling import fixed_size
from millrace.operators.skew import Heavy, every_part, heavy_keys, own_part, salted_join
from millrace.session import cut_lineage, shuffle_width, stored


def edges_from_adjacency(lines: DataFrame, value: str = "value") -> DataFrame:
    """Edges from text lines ``node \\t {'neighbour': links, …}``."""
    parts = F.split(F.col(value), "\t")
    links = F.from_json(F.get(parts, F.lit(1)), "map<string,int>", {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"})
    return lines.select(F.get(parts, F.lit(0)).alias("src"), F.explode(links).alias("dst", "weight"))


def sources_from_adjacency(lines: DataFrame, value: str = "value") -> DataFrame:
    """All record nodes, those with an empty link map included."""
    return lines.select(F.get(F.split(F.col(value), "\t"), F.lit(0)).alias("node")).distinct()


def merge_links(edges: DataFrame) -> DataFrame:
    """One row per (src, dst); parallel links add their weights."""
    return edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def nodes(edges: DataFrame) -> DataFrame:
    """Every node that is a source or a target."""
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()


def node_count(edges: DataFrame) -> DataFrame:
    return nodes(edges).agg(F.count("*").alias("nodes"))


def out_weights(edges: DataFrame) -> DataFrame:
    """``(src, out_weight, links)`` per source."""
    return edges.groupBy("src").agg(F.sum("weight").alias("out_weight"), F.count("*").alias("links"))


def node_table(edges: DataFrame) -> DataFrame:
    """``(node, links)``: out-edges of every node, 0 for a dangling one. One
    aggregate over both ends of the edges, no join."""
    ends = edges.select(
        F.explode(F.array(F.struct(F.col("src").alias("node"), F.lit(1).alias("out")), F.struct(F.col("dst").alias("node"), F.lit(0).alias("out")))).alias("_e")
    ).select("_e.node", "_e.out")
    return ends.groupBy("node").agg(F.sum("out").alias("links"))


def dangling(edges: DataFrame) -> DataFrame:
    """Nodes without out-edges."""
    return node_table(edges).where("links = 0").select("node")


def dangling_count(edges: DataFrame) -> DataFrame:
    return node_table(edges).agg(F.count("*").alias("nodes"), F.count_if(F.col("links") == 0).alias("dangling"))


def degree_report(edges: DataFrame, n: int = 10, sample: int = 1000, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Largest out-weights, their mean over non-dangling nodes, and a sample
    drawn by the hash of the node."""
    degrees = out_weights(edges)
    return (
        top_n(degrees, "out_weight", n, "src"),
        degrees.agg(F.avg("out_weight").alias("mean_out_weight")),
        fixed_size(degrees, ["src"], sample, seed),
    )


def adjacency_list(edges: DataFrame, part: int = 10_000) -> DataFrame:
    """``(src, part, neighbours)``: sorted neighbour arrays. A source with
    more than ``part`` links gets several rows, so no array grows without
    bound; a link's part follows from its target's key hash."""
    degrees = out_weights(edges)
    sliced = salted_join(edges, degrees, ["src"], ["dst"]).withColumn(
        "part", F.pmod(key_hash("dst"), F.greatest(F.ceil(F.col("links") / part), F.lit(1))).cast("int")
    )
    return sliced.groupBy("src", "part").agg(F.sort_array(F.collect_list(F.struct("dst", "weight"))).alias("neighbours"))


def adjacency_matrix(edges: DataFrame, columns: list | None = None) -> DataFrame:
    """0/1 matrix: long form, or wide over the listed targets."""
    long = edges.select("src", "dst").distinct().withColumn("value", F.lit(1))
    if columns is None:
        return long
    return long.groupBy("src").pivot("dst", columns).agg(F.first("value")).na.fill(0)


def transitions(edges: DataFrame, heavy: Heavy | None = None) -> DataFrame:
    """``(src, dst, p)``: link weight over the source's out-weight."""
    degrees = out_weights(edges)
    return salted_join(edges, degrees, ["src"], ["dst"], heavy=heavy).select(
        "src", "dst", (F.col("weight") / F.col("out_weight")).alias("p")
    )


class _Walk:
    """What every iteration reuses: transition rows placed by source, and the
    node list. Edges and nodes are reliable checkpoints, from which lost parts
    of the placed copy are rebuilt."""

    def __init__(self, edges: DataFrame):
        edges = stored(edges)
        self.heavy = heavy_keys(edges, ["src"])[0]
        self.nodes = stored(node_table(edges))
        self.keys = ["src", "salt"] if self.heavy else ["src"]
        placed = transitions(edges, self.heavy)
        if self.heavy:
            placed = own_part(placed, self.heavy, ["src"], ["dst"], "salt")
        width = shuffle_width(edges.sparkSession)
        self.placed = placed.repartition(width, *self.keys).sortWithinPartitions(*self.keys).persist()
        self.placed.count()  # once stored, its partitioning and order are known to the planner
        self.size = self.nodes.count()

    def spread(self, ranks: DataFrame) -> DataFrame:
        """Rank of each source, once per part its edges are cut into."""
        sources = ranks.where("links > 0").select(F.col("node").alias("src"), "rank")
        return every_part(sources, self.heavy, ["src"], "salt") if self.heavy else sources

    def received(self, ranks: DataFrame) -> DataFrame:
        return (
            self.placed.join(self.spread(ranks), self.keys)
            .groupBy(F.col("dst").alias("node"))
            .agg(F.sum(F.col("rank") * F.col("p")).alias("received"))
        )

    def close(self) -> None:
        self.placed.unpersist()


def pagerank(
    edges: DataFrame,
    alpha: float = 0.15,
    iterations: int = 10,
    tol: float | None = None,
    redistribute_dangling: bool = True,
    scale: float | None = None,
    metrics: list | None = None,
) -> DataFrame:
    """``(node, rank)`` with ``alpha/N + (1-alpha)*(m/N + received)``.

    ``m`` is the rank held by dangling nodes. Parallel links count by weight.
    Each iteration shuffles the ranks to the placed edges and the partial sums
    to their targets; the edges stay where they are. The new ranks are
    checkpointed, so the lineage never grows, and the two totals an iteration
    needs are one small aggregate over them.

    ``scale=N`` with ``redistribute_dangling=False`` gives the unnormalised
    variant whose ranks start at 1. ``metrics`` receives
    ``(iteration, total mass, dangling mass, L1 change)`` rows.
    """
    return _ranked(_Walk(merge_links(edges)), alpha, iterations, tol, redistribute_dangling, scale, metrics)


def _ranked(
    walk: _Walk,
    alpha: float,
    iterations: int,
    tol: float | None = None,
    redistribute_dangling: bool = True,
    scale: float | None = None,
    metrics: list | None = None,
) -> DataFrame:
    n = walk.size
    if not n:
        return walk.nodes.select("node", F.lit(0.0).alias("rank"))
    total = float(scale if scale is not None else 1.0)
    ranks = walk.nodes.select("node", "links", F.lit(total / n).alias("rank"))
    held = ranks.agg(F.coalesce(F.sum(F.when(F.col("links") == 0, F.col("rank"))), F.lit(0.0))).first()[0]
    for step in range(1, iterations + 1):
        share = held / n if redistribute_dangling else 0.0
        update = (
            ranks.join(walk.received(ranks), "node", "left")
            .select(
                "node",
                "links",
                (F.lit(alpha * total / n) + F.lit(1 - alpha) * (F.lit(share) + F.coalesce("received", F.lit(0.0)))).alias("new"),
                F.col("rank").alias("old"),
            )
        )
        ranks = cut_lineage(update.select("node", "links", F.col("new").alias("rank"), F.abs(F.col("new") - F.col("old")).alias("change")))
        mass, held, change = ranks.agg(
            F.sum("rank"), F.coalesce(F.sum(F.when(F.col("links") == 0, F.col("rank"))), F.lit(0.0)), F.sum("change")
        ).first()
        if metrics is not None:
            metrics.append((step, mass, held, change))
        if tol is not None and change < tol:
            break
    walk.close()
    return ranks.select("node", "rank")


def pagerank_unnormalised(edges: DataFrame, alpha: float = 0.15, iterations: int = 10) -> DataFrame:
    """Unweighted links, ranks starting at 1, no share for dangling mass. The
    links are stored before repeats go, so that no task counts them twice, in
    two tables of their size."""
    walk = _Walk(stored(edges).select("src", "dst").distinct().withColumn("weight", F.lit(1)))
    return _ranked(walk, alpha, iterations, redistribute_dangling=False, scale=float(walk.size))


def pagerank_mass(edges: DataFrame, alpha: float = 0.15, iterations: int = 10) -> DataFrame:
    """``(iteration, mass, dangling_mass, change)``: one row per iteration."""
    rows: list = []
    pagerank(edges, alpha, iterations, metrics=rows)
    return edges.sparkSession.createDataFrame(rows, "iteration int, mass double, dangling_mass double, change double")


def initial_ranks(edges: DataFrame) -> DataFrame:
    """``(node, links, rank)`` with every node, dangling ones too, at 1/N."""
    table = node_table(edges)
    size = table.agg(F.count("*").cast("double").alias("n"))
    return table.withColumn("rank", F.lit(1.0) / size.scalar())


def power_iteration(edges: DataFrame, start: DataFrame, iterations: int) -> DataFrame:
    """``(node, mass)`` after walking ``start(node, mass)`` without teleport.
    Mass that reaches a dangling node is lost in the next step."""
    walk = _Walk(merge_links(edges))
    ranks = walk.nodes.join(start.withColumnRenamed("mass", "rank"), "node", "left").na.fill(0.0, ["rank"])
    for _ in range(iterations):
        ranks = cut_lineage(
            walk.nodes.join(walk.received(ranks), "node", "left").select(
                "node", "links", F.coalesce("received", F.lit(0.0)).alias("rank")
            )
        )
    walk.close()
    return ranks.select("node", F.col("rank").alias("mass"))


def top_ranked_named(ranks: DataFrame, titles: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` best ranked nodes with their titles from ``(node, title)``.
    The top list has ``n`` rows, so it is the broadcast side."""
    best = top_n(ranks, "rank", n, "node")
    return titles.join(F.broadcast(best), "node").select("node", "title", "rank").orderBy(F.desc("rank"), "node")
