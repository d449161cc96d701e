import math
import random
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from results import rows
from millrace.functions import clean
from millrace.functions.hashing import key_fraction
from millrace.operators import joins, nearest, profile, sampling, skew
from millrace.session import checkpoint_dir, cut_lineage


def test_composites_and_sentinels(spark):
    df = spark.createDataFrame([("999,9,C,9999,9",), ("160,1,N,0046,1",), ("160",), ("x,1,N,y,1",)], "WND string")
    out = clean.clean_composites(df, [("angle", "WND", 0, 999, 0), ("speed", "WND", 3, 9999, 0)])
    assert [(r.angle, r.speed) for r in out.collect()] == [(0, 0), (160, 46), (160, None), (None, None)]


def test_clock_modes(spark):
    df = spark.createDataFrame([(50,), (1249,), (1250,), (1350,), (2350,)], "t int")
    got = df.select(clean.clock_hour("t", "half_even"), clean.clock_hour("t"), clean.clock_minutes("t")).collect()
    assert [r[0] for r in got] == [0, 12, 12, 14, 24]
    assert [r[1] for r in got] == [0, 12, 12, 13, 23]
    assert [r[2] for r in got] == [50, 769, 770, 830, 1430]
    with pytest.raises(ValueError):
        clean.clock_hour("t", "other")


def test_blank_null_prefix(spark):
    df = spark.createDataFrame([(" ", None), ("a", 3)], "s string, n int")
    assert rows(df.select(clean.blank_to_null("s"), "n")) == {(None, None), ("a", 3)}
    assert rows(clean.nulls_to_zero(df, ["n"]).select("n")) == {(0,), (3,)}
    assert clean.prefixed(df, "ORG_", keep=["n"]).columns == ["ORG_s", "n"]
    assert clean.unique_columns(["a", "b", "a"]) == ["a", "b"]


def test_profiles(spark):
    df = spark.createDataFrame([(1, "x", " "), (2, None, "b"), (2, "x", None), (None, "y", "")], "n int, s string, t string")
    assert rows(profile.distinct_counts(df)) == {("n", 2), ("s", 2), ("t", 3)}
    assert rows(profile.distinct_counts(df, approx=True)) == {("n", 2), ("s", 2), ("t", 3)}
    assert rows(profile.null_counts(df)) == {("n", 1), ("s", 1), ("t", 1)}
    assert rows(profile.blank_fractions(df, ["s", "t"])) == {("s", 0.25), ("t", 0.75)}
    assert [r["column"] for r in profile.complete_columns(df, ["s", "t"], 0.7).collect()] == ["s"]


def test_all_null_column_counts_zero(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    assert rows(profile.distinct_counts(df)) == {("a", 2), ("b", 0)}


def test_outcomes(spark):
    df = spark.createDataFrame([(1, "a"), (0, "a"), (0, "b"), (0, None)], "y int, d string")
    assert tuple(profile.outcome_odds(df, F.col("y") == 1).first()) == (1, 3, 0.25, pytest.approx(1 / 3))
    got = rows(profile.outcome_rates(df, F.col("y") == 1, {"d": F.col("d"), "p": F.lit(7)}))
    assert got == {("d", "a", 0.5, 2), ("d", "b", 0.0, 1), ("d", None, 0.0, 1), ("p", "7", 0.25, 4)}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 10]], "v double")
    assert {(r.bin, r.n) for r in profile.histogram(df, "v", 5).collect()} == {(1, 2), (2, 2), (5, 1)}
    assert {(r.bin, r.n) for r in profile.histogram(df, "v", 3, upper=3).collect()} == {(1, 1), (2, 1), (3, 2)}
    same = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert {(r.bin, r.n) for r in profile.histogram(same, "v", 3).collect()} == {(1, 2)}


def test_box_and_summary(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(1, 9)], "k string, v double")
    assert tuple(profile.box_stats(df, "k", "v").first()) == ("a", 1, 2, 4, 6, 8, 8)
    r = profile.describe(df, ["v"]).first()
    assert (r.n, r["mean"], r.low, r.median, r.high) == (8, 4.5, 1, 4, 8)


def test_heavy_keys_are_found(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 1000)
    monkeypatch.setattr(skew, "SAMPLE", 1)
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    heavy = skew.heavy_keys(df, ["k"], ["id"])
    assert heavy == [{spark.range(1).select(F.xxhash64(F.lit(-1).cast("long"))).first()[0]: 10}, {}]


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 300)
    monkeypatch.setattr(skew, "SAMPLE", 1)


def test_small_tables_have_no_heavy_keys(spark):
    assert skew.heavy_keys(spark.range(100).select(F.lit(1).alias("k")), ["k"]) == [{}]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how, small_tasks):
    """A third of the left rows on one key, another third without a key."""
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).cast("int").alias("k")
    )
    right = spark.createDataFrame([(1, "a"), (1, "b"), (5, "c"), (8, "d"), (None, "e")], "k long, v string")
    got = skew.salted_join(left, right, ["k"], ["id"], how)
    want = left.join(right, "k", how)
    assert sorted(map(str, got.select("id", "k", "v").collect())) == sorted(map(str, want.select("id", "k", "v").collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_both_sides_are_split(spark, how, small_tasks):
    left = spark.range(900).select("id", F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id")).cast("int").alias("k"))
    right = spark.range(900).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 400).alias("k"), F.col("id").alias("v"))
    heavy, other = skew.heavy_keys(left, ["k"])[0], skew.heavy_keys(right.select(F.col("k").cast("int")), ["k"])[0]
    assert len(heavy) == len(other) == 1
    cells = skew.own_part(left.where("k = 1"), heavy, ["k"], ["id"], "s").groupBy("s").count().agg(F.max("count")).first()[0]
    assert cells <= 300
    got = skew.salted_join(left, right, ["k"], ["id"], how, heavy, None, other)
    want = left.join(right, "k", how)
    assert sorted(map(str, got.select("id", "k", "v").collect())) == sorted(map(str, want.select("id", "k", "v").collect()))


def test_salted_join_spreads_the_heavy_key(spark, small_tasks):
    left = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    right = spark.range(20_000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    heavy = skew.heavy_keys(left, ["k"])[0]
    salted = skew.own_part(left, heavy, ["k"], ["id"], "s")
    largest = salted.groupBy("k", "s").count().agg(F.max("count")).first()[0]
    assert largest < 400  # of 6667 rows with the heavy key
    assert skew.salted_join(left, right, ["k"], ["id"]).count() == 20_000


def test_ten_thousand_heavy_keys(spark, monkeypatch):
    """All of them are split by a broadcast side table, none by a literal."""
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 5)
    monkeypatch.setattr(skew, "SAMPLE", 1)
    left = spark.range(150_000).select("id", (F.col("id") % 12_500).alias("k"))
    right = spark.range(12_500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    heavy = skew.heavy_keys(left, ["k"])[0]
    assert len(heavy) == skew.LISTED
    joined = skew.salted_join(left, right, ["k"], ["id"], heavy=heavy)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "map(" not in plan and len(plan) < 20_000
    got = joined.agg(F.count("*"), F.sum(F.col("v") - 2 * F.col("k")), F.countDistinct("id")).first()
    assert tuple(got) == (150_000, 0, 150_000)


@pytest.mark.parametrize("heavy_left", [True, False])
def test_window_join_splits_a_heavy_right_key(spark, monkeypatch, heavy_left):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 40)
    monkeypatch.setattr(skew, "SAMPLE", 1)
    rng = random.Random(15)
    left = [(i, None if i % 50 == 0 else "hot" if heavy_left and i % 3 == 0 else f"k{i % 9}" if i % 4 else "hot", rng.randrange(1440)) for i in range(200)]
    right = [(i, "hot" if i % 2 else f"k{i % 11}", rng.randrange(1440)) for i in range(800)]
    a, b = spark.createDataFrame(left, "id int, k string, at int"), spark.createDataFrame(right, "rid int, k string, e int")
    near = b.withColumn("_bucket", F.explode(F.sequence(F.floor((F.col("e") + 120) / 120), F.floor((F.col("e") + 240) / 120))))
    heavy = skew.heavy_keys(a.withColumn("_bucket", joins.window_bucket(F.col("at"), 120, 240)), ["k", "_bucket"])[0]
    heavy_right = skew.heavy_keys(near, ["k", "_bucket"])[0]
    assert heavy_right
    want = set()
    for i, k, at in left:
        hits = [(i, j) for j, q, e in right if q == k and at - 240 < e < at - 120]
        want |= set(hits) or {(i, None)}
    got = joins.window_self_join(a, b, ["k"], "at", "e", 120, 240, ["id"], heavy, heavy_right).select("id", "rid")
    assert got.count() == len(want) and rows(got) == want


def test_global_rank(spark):
    ids = random.Random(1).sample(range(10**6), 2000)
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r.id: r["rank"] for r in skew.global_rank(df, "id").collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(ids))}


def test_running_totals(spark):
    rng = random.Random(2)
    data = [(rng.randrange(50), rng.randrange(9), i) for i in range(1000)]
    df = spark.createDataFrame(data, "k int, v int, id int")
    got = {r.id: (r.s, r.c) for r in skew.running(df.withColumn("one", F.lit(1)), [F.desc("k"), "id"], {"s": "v", "c": "one"}).collect()}
    total, want = 0, {}
    for n, (k, v, i) in enumerate(sorted(data, key=lambda x: (-x[0], x[2])), 1):
        total += v
        want[i] = (total, n)
    assert got == want


def test_running_totals_within_groups(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), rng.randrange(9), i) for i in range(900)] + [("c", 1, 900)]
    df = spark.createDataFrame(data, "k string, v int, id int")
    got = {r.id: r.s for r in skew.running(df, ["k", "id"], {"s": "v"}, within=["k"]).collect()}
    total, want = {}, {}
    for k, v, i in sorted(data, key=lambda x: x[2]):
        want[i] = total[k] = total.get(k, 0) + v
    assert got == want


@pytest.mark.parametrize("accuracy", [10, 1000])
def test_exact_quantiles(spark, accuracy):
    rng = random.Random(8)
    # a heavy group of two values, with a wanted rank at their border, beside one of many values
    values = {"two": [0.0] * 2500 + [1.0] * 7500, "many": [rng.random() for _ in range(10_000)], "a": [rng.gauss(0, 1) for _ in range(3000)], "b": [float(rng.randrange(3)) for _ in range(2000)], "c": [5.0], None: [1.0, 2.0]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs] + [("d", None)], "k string, v double")
    got = {(r.by, r.which): r.quantile for r in profile.exact_quantiles(df, "k", "v", accuracy=accuracy).collect()}
    want = {(k, i): sorted(vs)[max(1, math.ceil(p * len(vs))) - 1] for k, vs in values.items() for i, p in enumerate((0.25, 0.5, 0.75))}
    assert got == want


def test_quartiles_of_many_rows_are_exact(spark):
    n = 3_000_001
    df = spark.range(n).select(F.lit("x").alias("k"), ((F.col("id") * 7919) % n).alias("v"))
    assert tuple(profile.box_stats(df, "k", "v").first())[1:6] == (0, 750000, 1500000, 2250000, n - 1)


def test_quantiles_of_any_share(spark):
    rng = random.Random(9)
    vs = [rng.expovariate(1) for _ in range(5000)]
    df = spark.createDataFrame([("x", v) for v in vs], "k string, v double")
    probs = [0.99, 0.0, 0.5, 1.0, 0.501]
    got = {r.which: r.quantile for r in profile.exact_quantiles(df, "k", "v", probs, accuracy=20).collect()}
    assert got == {i: sorted(vs)[max(1, math.ceil(p * 5000)) - 1] for i, p in enumerate(probs)}
    assert profile.exact_quantiles(df.where("v < 0"), "k", "v").collect() == []


def test_window_self_join_bounds(spark):
    left = spark.createDataFrame([(1, "t", 1300), (2, "t", 500), (3, None, 1300)], "id int, k string, at int")
    right = spark.createDataFrame([("t", 900, "a"), ("t", 901, "b"), ("t", 1099, "c"), ("t", 1100, "d"), (None, 1000, "e")], "k string, arr int, v string")
    got = joins.window_self_join(left, right, ["k"], "at", "arr", 200, 400, ["id"])
    assert rows(got.select("id", "v")) == {(1, "b"), (1, "c"), (2, None), (3, None)}


def test_window_self_join_matches_brute_force(spark):
    rng = random.Random(5)
    left = [(i, "hot" if i % 3 == 0 else f"k{i % 7}", rng.randrange(1440)) for i in range(300)]
    right = [(i, "hot" if i % 3 == 0 else f"k{i % 7}", rng.randrange(1440)) for i in range(300)]
    want = set()
    for i, k, at in left:
        hits = [(i, j) for j, q, e in right if q == k and at - 240 < e < at - 120]
        want |= set(hits) or {(i, None)}
    got = joins.window_self_join(
        spark.createDataFrame(left, "id int, k string, at int"), spark.createDataFrame(right, "rid int, k string, e int"), ["k"], "at", "e", 120, 240, ["id"]
    )
    assert rows(got.select("id", "rid")) == want


def test_window_summary_matches_brute_force(spark):
    rng = random.Random(6)
    left = [(i, "hot" if i % 3 == 0 else f"k{i % 7}", rng.randrange(1440)) for i in range(300)]
    right = [("hot" if i % 3 == 0 else f"k{i % 7}", rng.randrange(1440), float(rng.randrange(50)) if i % 5 else None) for i in range(300)]
    want = {}
    for i, k, at in left:
        hits = [v for q, e, v in right if q == k and at - 240 < e < at - 120]
        known = [v for v in hits if v is not None]
        want[i] = (len(hits), pytest.approx(sum(known) / len(known)) if known else None, max(known) if known else None)
    got = joins.window_self_summary(
        spark.createDataFrame(left, "id int, k string, at int"), spark.createDataFrame(right, "k string, e int, v double"), ["k"], "at", "e", 120, 240, "v", ["id"]
    )
    assert {r.id: (r.matches, r.mean_v, r.max_v) for r in got.collect()} == want


@pytest.mark.parametrize("fan, roots", [(32, 64), (3, 2)])
@pytest.mark.parametrize("kind", ["uniform", "clusters", "line", "few"])
def test_nearest_matches_brute_force(spark, monkeypatch, kind, fan, roots):
    monkeypatch.setattr(nearest, "FAN", fan)
    monkeypatch.setattr(nearest, "ROOTS", roots)
    rng = random.Random(11)
    if kind == "uniform":
        sites = [(f"s{i:04d}", rng.uniform(0, 1), rng.uniform(0, 1)) for i in range(400)]
    elif kind == "clusters":  # a third within a tiny spot, and exact copies
        sites = [(f"s{i:04d}", 5 + rng.uniform(0, 1e-6), 5 + rng.uniform(0, 1e-6)) for i in range(200)]
        sites += [(f"s{200 + i:04d}", rng.choice([0.0, 9.0]), rng.choice([0.0, 9.0])) for i in range(200)]
    elif kind == "line":
        sites = [(f"s{i:04d}", float(i), 2.0) for i in range(100)]
    else:
        sites = [("s1", 1.0, 1.0), ("s0", 1.0, 1.0), ("s2", None, 1.0)]
    asked = [(i, rng.uniform(-2, 12), rng.uniform(-2, 12)) for i in range(120)] + [(1000 + i, 3.0, 3.0) for i in range(60)] + [(2000, None, 1.0)]
    got = {r.q: (r.s, r.distance) for r in nearest.nearest_site(
        spark.createDataFrame(asked, "q int, x double, y double"), spark.createDataFrame(sites, "s string, x double, y double"), "q", "s", "x", "y"
    ).collect()}
    known = [s for s in sites if s[1] is not None]
    assert set(got) == {q for q, x, _ in asked if x is not None}
    for q, x, y in asked:
        if x is None:
            continue
        d2, best = min(((sx - x) ** 2 + (sy - y) ** 2, s) for s, sx, sy in known)
        assert got[q][1] == pytest.approx(d2**0.5)
        if kind != "clusters":
            assert got[q][0] == best


@pytest.mark.parametrize("fan, roots", [(32, 64), (2, 2)])
def test_nearest_on_the_sphere(spark, monkeypatch, fan, roots):
    monkeypatch.setattr(nearest, "FAN", fan)
    monkeypatch.setattr(nearest, "ROOTS", roots)
    rng = random.Random(12)
    spot = lambda: (math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180))
    sites = [(f"s{i:04d}", *spot()) for i in range(300)] + [("s9000", 0.0, 179.95), ("s9001", 89.9, 10.0), ("s9002", 89.9, 10.0)]
    asked = [(i, *spot()) for i in range(100)] + [(500, 0.01, -179.99), (501, 89.95, -170.0), (502, -90.0, 0.0), (503, None, 1.0)]

    def along(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * nearest.EARTH_KM * math.asin(math.sqrt(h))

    got = {r.q: (r.s, r.distance) for r in nearest.nearest_site(
        spark.createDataFrame(asked, "q int, x double, y double"), spark.createDataFrame(sites, "s string, x double, y double"), "q", "s", "x", "y", sphere=True
    ).collect()}
    assert len(got) == 103 and got[500][0] == "s9000" and got[501][0] == "s9001"
    for q, x, y in asked[:-1]:
        d, best = min((along(x, y, sx, sy), s) for s, sx, sy in sites)
        assert got[q] == (best, pytest.approx(d, abs=1e-6))


def test_far_boxes_are_not_gathered(spark, monkeypatch):
    monkeypatch.setattr(nearest, "FAN", 4)
    monkeypatch.setattr(nearest, "ROOTS", 2)
    rows = spark.range(200).selectExpr("id", "CAST(id % 17 AS DOUBLE) AS x", "CAST(id % 13 AS DOUBLE) AS y")
    found = nearest.nearest_site(rows, rows, "id", "id", "x", "y")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert sum("<= bound" in line for line in joins) == 3  # one per level below the top
    assert found.where("distance > 0").count() == 0


def test_nearest_of_no_sites(spark):
    none = spark.createDataFrame([], "s string, x double, y double")
    asked = spark.createDataFrame([(1, 1.0, 1.0)], "q int, x double, y double")
    assert nearest.nearest_site(asked, none, "q", "s", "x", "y").collect() == []


def test_samples_and_splits(spark):
    df = spark.range(10_000)
    part = sampling.hash_sample(df, ["id"], 0.1).cache()
    assert 850 < part.count() < 1150
    assert rows(part) == rows(sampling.hash_sample(df.repartition(13), ["id"], 0.1))
    assert sampling.fixed_size(df, ["id"], 77).count() == 77
    assert rows(sampling.fixed_size(df, ["id"], 9)) == rows(sampling.fixed_size(df.repartition(5), ["id"], 9))
    folds = sampling.assign_folds(df, ["id"], 5).groupBy("fold").count().collect()
    assert len(folds) == 5 and all(1800 < r["count"] < 2200 for r in folds)
    assert 7800 < sampling.hash_split(df, ["id"]).where("is_train").count() < 8200
    assert df.select(key_fraction("id").alias("f")).where("f < 0 or f >= 1").count() == 0
    a, b = sampling.random_split(df, [0.8, 0.2])
    assert a.count() + b.count() == 10_000 and a.intersect(b).count() == 0
    assert 0 < sampling.with_replacement(df, 0.01).count() < 300


def test_positional_split(spark):
    df = spark.range(100).select((F.col("id") * 7 % 1009).alias("id"))
    order = sorted(i * 7 % 1009 for i in range(100))
    got = {r.id for r in sampling.positional_split(df, "id", first=80).where("is_train").collect()}
    assert got == set(order[:80])
    assert got == {r.id for r in sampling.positional_split(df, "id", fraction=0.8).where("is_train").collect()}


def test_time_split(spark):
    df = spark.createDataFrame([(date(2018, 5, 1),), (date(2019, 1, 1),)], "d date")
    assert [r.is_train for r in sampling.time_split(df, F.year("d"), 2019).collect()] == [True, False]


class _Session:
    """Stands in for a session with a given setting and master."""

    def __init__(self, named, master):
        self.conf = SimpleNamespace(get=lambda key, default: named)
        self.dir = None
        self.sparkContext = SimpleNamespace(
            master=master, getCheckpointDir=lambda: self.dir, setCheckpointDir=lambda path: setattr(self, "dir", path)
        )


def test_checkpoint_folder_is_taken_from_the_session(spark):
    assert checkpoint_dir(_Session("hdfs:///shared", "yarn")) == "hdfs:///shared"
    local = _Session(None, "local[8]")
    assert checkpoint_dir(local) == local.dir
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session(None, "yarn"))
    assert cut_lineage(spark.range(5)).count() == 5


def test_window_self_join_computes_a_time_once(spark):
    """A time that takes work is not computed again for each bound of its
    buckets, nor in filters that Spark adds for them."""
    left = spark.createDataFrame([(i % 3, i, i) for i in range(40)], "k int, at int, id int")
    right = left.select("k", (F.col("at") * 7919 - F.col("at") * 7918).alias("arr"), F.col("id").alias("rid"))
    got = joins.window_self_join(left, right, ["k"], "at", "arr", 5, 12, ["id"], {}, {})
    assert got._jdf.queryExecution().optimizedPlan().toString().count("7919") == 1
    want = {(a, b) for a in range(40) for b in range(40) if a % 3 == b % 3 and a - 12 < b < a - 5}
    assert {(r.id, r.rid) for r in got.collect() if r.rid is not None} == want
