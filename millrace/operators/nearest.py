"""Nearest site for every query point, in the plane or on the sphere, without
a cross join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.skew import global_rank
from millrace.session import stored

FAN = 32  # sites in a leaf, and boxes below a box
ROOTS = 64  # boxes at the top at most; every query looks at them all
EARTH_KM = 6371.0088  # mean radius

# Fixed values: (shift, mask) steps that spread the bits of a number, one or two places apart.
_SPREAD = {
    2: (30, [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]),
    3: (20, [(32, 0x001F00000000FFFF), (16, 0x001F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)]),
}


def _plane(x: str, y: str) -> list[Column]:
    return [F.col(x).cast("double"), F.col(y).cast("double")]


def _sphere(latitude: str, longitude: str) -> list[Column]:
    """Unit vector of a place; straight distances between unit vectors order
    as distances along the sphere do, across the date line and at the poles."""
    lat, lon = F.radians(F.col(latitude).cast("double")), F.radians(F.col(longitude).cast("double"))
    return [F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)]


def _curve(places: DataFrame, axes: list[str]) -> DataFrame:
    """Adds ``_code``, the place's number along a curve that keeps near places
    together: the bits of its scaled coordinates in turn."""
    bits, steps = _SPREAD[len(axes)]
    ends = places.agg(F.struct(*[f(a).alias(f"{a}_{n}") for a in axes for f, n in ((F.min, "lo"), (F.max, "hi"))]).alias("e")).scalar()
    code = F.lit(0).cast("long")
    for i, a in enumerate(axes):
        lo, hi = F.col(f"_e.{a}_lo"), F.col(f"_e.{a}_hi")
        unit = F.when(hi > lo, (F.col(a) - lo) / (hi - lo)).otherwise(0.0)
        part = F.least(F.floor(unit * (1 << bits)), F.lit((1 << bits) - 1)).cast("long")
        for shift, mask in steps:
            part = part.bitwiseOR(F.shiftleft(part, shift)).bitwiseAND(mask)
        code = code.bitwiseOR(F.shiftleft(part, i))
    return places.withColumn("_e", ends).withColumn("_code", code).drop("_e")


def _near(axes: list[str], box: Callable[[str], Column]) -> Column:
    """Squared distance from a query to a box; 0 inside."""
    out = F.lit(0.0)
    for a in axes:
        q = F.col(f"q{a}")
        out = out + F.pow(F.greatest(box(f"lo{a}") - q, q - box(f"hi{a}"), F.lit(0.0)), 2)
    return out


def _cap(axes: list[str], box: Callable[[str], Column]) -> Column:
    """Squared distance within which a box surely has a site: it is tight, so
    each of its faces holds one."""
    far, face = {}, {}
    for a in axes:
        q, lo, hi = F.col(f"q{a}"), box(f"lo{a}"), box(f"hi{a}")
        far[a] = F.pow(F.greatest(F.abs(q - lo), F.abs(q - hi)), 2)
        face[a] = F.pow(F.least(F.abs(q - lo), F.abs(q - hi)), 2)
    sums = []
    for a in axes:
        total = face[a]
        for b in axes:
            if b != a:
                total = total + far[b]
        sums.append(total)
    return F.least(*sums)


def nearest_site(
    queries: DataFrame, sites: DataFrame, query: str, site: str, x: str, y: str, sphere: bool = False, radius: float = EARTH_KM
) -> DataFrame:
    """``(query, site, distance)``: the nearest site of each query point; equal
    distances go to the smallest site id.

    Plane: Euclidean distance. ``sphere``: ``x`` and ``y`` are latitude and
    longitude in degrees and the distance is that along a sphere of ``radius``.

    Sites are numbered along a space-filling curve; ``FAN`` neighbours make a
    leaf and ``FAN`` boxes the next one up, so the tree is balanced wherever
    the sites lie, and its depth follows from their number. Each query walks
    down with the boxes that may still hold its nearest site. Every step is an
    equi-join on the box, so the work per query grows with the depth and not
    with the number of sites.
    """
    place = _sphere if sphere else _plane
    axes = ["0", "1", "2"] if sphere else ["0", "1"]
    spots = sites.select(F.col(site).alias("site"), *[c.alias(a) for c, a in zip(place(x, y), axes)]).na.drop()
    places = stored(spots.groupBy(*axes).agg(F.min("site").alias("site")))
    ranked = global_rank(_curve(places, axes), ["_code", *axes], "_rank")
    placed = stored(ranked.select("site", *axes, F.floor((F.col("_rank") - 1) / FAN).alias("node")))
    leaves, levels = max(1, -(-placed.count() // FAN)), 1
    while leaves > ROOTS * FAN ** (levels - 1):
        levels += 1

    # boxes of all levels, from one pass over the sites; level 1 are the leaves
    lows, highs = [f"lo{a}" for a in axes], [f"hi{a}" for a in axes]
    tight = placed.groupBy("node").agg(*[F.min(a).alias(n) for a, n in zip(axes, lows)], *[F.max(a).alias(n) for a, n in zip(axes, highs)])
    above = F.floor(F.col("node") / F.pow(F.lit(float(FAN)), F.col("level") - 1)).alias("node")
    boxes = tight.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(levels)))).groupBy("level", above)
    boxes = stored(boxes.agg(*[F.min(c).alias(c) for c in lows], *[F.max(c).alias(c) for c in highs]).withColumn("up", F.floor(F.col("node") / FAN)))

    asked = queries.select(F.col(query).alias("query"), *[c.alias(f"q{a}") for c, a in zip(place(x, y), axes)]).na.drop()
    point = [f"q{a}" for a in axes]
    slack = 1 + 1e-12
    # at most ROOTS boxes: one array, looked through by every point
    roots = boxes.where(F.col("level") == levels).agg(F.collect_list(F.struct("node", *lows, *highs)))
    inside = lambda b: (lambda c: b[c])
    frontier = (
        asked.select(*point).distinct()
        .withColumn("_r", roots.scalar())
        .withColumn("bound", F.array_min(F.transform("_r", lambda b: _cap(axes, inside(b)))) * slack)
        .select(*point, "bound", F.explode(F.filter("_r", lambda b: _near(axes, inside(b)) <= F.col("bound"))).alias("_b"))
        .select(*point, "bound", F.col("_b.node").alias("up"))
    )
    for level in range(levels - 1, 0, -1):
        # what lies beyond the bound so far cannot lower it either, and is not moved
        met = frontier.join(boxes.where(F.col("level") == level), "up").where(_near(axes, F.col) <= F.col("bound"))
        kept = met.groupBy(*point).agg(
            F.least(F.min("bound"), F.min(_cap(axes, F.col)) * slack).alias("bound"), F.collect_list(F.struct("node", _near(axes, F.col).alias("near"))).alias("_c")
        )
        frontier = kept.select(*point, "bound", F.inline(F.filter("_c", lambda b: b["near"] <= F.col("bound")))).select(*point, "bound", F.col("node").alias("up"))
    square = F.lit(0.0)
    for a in axes:
        square = square + F.pow(F.col(a) - F.col(f"q{a}"), 2)
    best = frontier.withColumnRenamed("up", "node").join(placed, "node").groupBy(*point).agg(F.min(F.struct(square.alias("d2"), "site")).alias("_b"))
    straight = F.sqrt("_b.d2")
    distance = 2 * radius * F.asin(F.least(straight / 2, F.lit(1.0))) if sphere else straight
    best = best.select(*point, "_b.site", distance.alias("distance"))
    return asked.join(best, point).select(F.col("query").alias(query), F.col("site").alias(site), "distance")
