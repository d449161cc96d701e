"""Connected components of a link table, by alternating stars.

Each round hangs a node's larger neighbours on its smallest one, then its
smaller ones. Both steps keep the components, and after a number of rounds
logarithmic in the longest path every node hangs on the smallest of its
component. No node's neighbours are ever gathered: a step is a minimum per
node, combined map-side, and a join. Each round is written to shared storage.
Packed link files are far smaller than their rows, so no side is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.session import discard, stored


def connected(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for every node of ``links``
    (bigint ``a``, ``b``). Loops and repeated links do no harm; null ends are
    left out; no links give no rows."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    links = stored(links.distinct())
    before = None
    while True:
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
        older, links = links, stored(_small_star(_large_star(links)))
        discard(older)
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(links.select("b", "b").distinct())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least.hint("merge"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    # all links lead from the larger node to the smaller one
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least.hint("merge"), "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least).distinct()
