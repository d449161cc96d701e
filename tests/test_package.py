"""Packaged run, tree tables and the optimality check."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import classify, forest, sampling
from millrace.plans import derived, flights, model_queries, package
from millrace.session import scratch, stored
from millrace.sources import readers, writers

FOLDER = "/root/testdata/sf0.001"
FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = [(i, *(x := [rng.gauss(0, s) for s in (1, 5, 0.1)]), float(x[0] + x[1] / 5 + rng.gauss(0, 1) > 0.3)) for i in range(2000)]
    return stored(spark.createDataFrame(rows, "id long, a double, b double, c double, y double"))


@pytest.mark.parametrize("kind, score, params", [("rf", forest.forest_scores, {"trees": 7}), ("gbt", forest.boosted_scores, {"max_iter": 4})])
def test_tree_table(spark, labelled, kind, score, params):
    model = classify.fit(labelled, "y", FEATURES, kind, **params)
    path = scratch(spark)
    classify.save_model(model, path)
    trees = forest.tree_table(spark, path)
    got = score(labelled, trees, "id", FEATURES, forest.depth(model)).collect()
    want = {r.id: r.p1 for r in classify.score(model, labelled).collect()}
    assert len(got) == len(want) and all(abs(want[r.id] - r.p1) < 1e-9 for r in got)
    shares = {r.feature: r.importance for r in forest.gain_importances(trees, FEATURES, per_tree=kind == "rf").collect()}
    own = model.stages[-1].featureImportances.toArray()
    assert all(abs(shares.get(f, 0) - own[i]) < 1e-9 for i, f in enumerate(FEATURES))
    # counts go down the tree without loss
    held = {(r.tree, r.node): r for r in trees.collect()}
    for r in held.values():
        if r.left is not None:
            assert math.isclose(held[r.tree, r.left].held + held[r.tree, r.right].held, r.held)


def test_scores_take_columns_along(spark, labelled):
    """A model's own score goes with its row through the trees' table, so that
    the two need no join; a row's leaf brings its share ready made."""
    for kind, score, params in (("rf", forest.forest_scores, {"trees": 3}), ("gbt", forest.boosted_scores, {"max_iter": 2})):
        model = classify.fit(labelled, "y", FEATURES, kind, **params)
        path = scratch(spark)
        classify.save_model(model, path)
        trees = stored(forest.tree_table(spark, path))
        scored = classify.score(model, labelled).withColumnRenamed("p1", "want")
        got = score(scored, trees, ["id", "want"], FEATURES, forest.depth(model))
        assert got.columns == ["id", "want", "p1"] and got.count() == 2000
        assert got.where(F.abs(F.col("p1") - F.col("want")) > 1e-9).count() == 0
        with_nulls = scored.withColumn("want", F.when(F.col("id") > 9, F.col("want")))
        assert score(with_nulls, trees, ["id", "want"], FEATURES, forest.depth(model)).where("want IS NULL").count() == 10


@pytest.mark.parametrize("penalty", [(0.0, 0.0), (0.1, 0.0), (0.05, 1.0), (0.05, 0.8)])
def test_optimality(labelled, penalty):
    reg, net = penalty
    fit = lambda steps: classify.fit(labelled, "y", FEATURES, "lr", max_iter=steps, tol=1e-12, regParam=reg, elasticNetParam=net)
    worst = lambda model: classify.optimality(model, labelled, "y", FEATURES, reg, net).agg(F.max("violation")).first()[0]
    assert worst(fit(300)) < 1e-5
    assert worst(fit(1)) > 1e-3  # not there yet


def test_poisson_copies(spark):
    df = spark.range(40_000)
    counts = {r.n: r.rows for r in sampling.poisson_copies(df, ["id"], 0.5).groupBy("id").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("rows")).collect()}
    for n in range(1, 4):
        want = 40_000 * math.exp(-0.5) * 0.5**n / math.factorial(n)
        assert abs(counts[n] - want) < 5 * math.sqrt(want)
    again = sampling.poisson_copies(df.repartition(7), ["id"], 0.5)
    assert again.exceptAll(sampling.poisson_copies(df, ["id"], 0.5)).count() == 0


@pytest.fixture(scope="module")
def trained(spark):
    raw, weather = derived.raw_flights(spark, FOLDER), flights.clean_weather(derived.raw_weather(spark, FOLDER))
    known = flights.clean_flights(raw)
    index = stored(flights.delay_index(known))
    stations = stored(flights.station_index(weather, derived.airport_rows(spark, FOLDER)))
    rows = stored(flights.labelled(flights.attach_delay_index(flights.attach_inbound(known), index), flights.INDEX_SET[-4:]))
    model = classify.fit(rows, flights.LABEL, flights.INDEX_SET[-4:], "gbt", max_iter=1)
    return raw, model, index, stations


def test_package(spark, trained):
    raw, model, index, stations = trained
    folder, out, weather = scratch(spark), scratch(spark), scratch(spark)
    writers.write_parquet(derived.raw_weather(spark, FOLDER), weather)
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    for day in days:
        writers.write_parquet(raw.where(F.col("FL_DATE") == day).coalesce(1), f"{out}/in/{day}")
    with pytest.raises(FileNotFoundError):
        package.load(spark, folder)
    features = flights.INDEX_SET[-4:]
    assert package.publish(spark, folder, model, index, stations, features) == "v000001"
    # a writer that died leaves a folder that does not count
    writers.write_parquet(index, f"{folder}/_new-dead/delay_index")
    assert package.publish(spark, folder, model, index, stations, features) == "v000002"
    use = package.load(spark, folder)
    assert use.version == "v000002" and use.features == features and package.load(spark, folder, "v000001").version == "v000001"

    def run(some):
        return package.score_new(spark, folder, [f"{out}/in/{d}" for d in some], weather, f"{out}/scored", ["FL_DATE", "TAIL_NUM"])

    assert run(days[:1]) == "batch-000001"
    one = package.scores(spark, f"{out}/scored").count()
    assert run(days[:1]) is None and package.scores(spark, f"{out}/scored").count() == one
    writers.write_parquet(readers.parquet(spark, f"{out}/in/{days[0]}"), f"{out}/scored/_new-dead/files")
    assert run(days) == "batch-000002" and run(days) is None
    found = package.scores(spark, f"{out}/scored")
    assert {r.FL_DATE.isoformat() for r in found.select("FL_DATE").distinct().collect()} == set(days)
    whole = flights.score_flights(spark, model, [f"{out}/in/{d}" for d in days], weather, None, index, stations, features, ["FL_DATE", "TAIL_NUM"])
    assert whole.exceptAll(found.select(whole.columns)).count() == 0 and whole.count() == found.count()
    files = package.scored_files(spark, f"{out}/scored")
    assert files.count() == files.select("file").distinct().count() == 3


def test_taken_number(spark):
    """A number that another job takes first is left to it."""
    folder = scratch(spark)
    writers.write_parquet(spark.range(1), f"{folder}/_new-a")
    writers.write_parquet(spark.range(1), f"{folder}/_new-b")
    assert package._put(spark, f"{folder}/_new-a", folder, "v") == "v000001"
    assert package._put(spark, f"{folder}/_new-b", folder, "v") == "v000002"
    assert package._numbered(spark, folder, "v") == ["v000001", "v000002"]


def test_heavy_keys_are_measured_on_plain_flights(spark, monkeypatch):
    """The joined rows would be joined once more to be measured."""
    measured, heavy_flight_keys = [], flights.heavy_flight_keys
    monkeypatch.setattr(flights, "heavy_flight_keys", lambda rows, *clock: measured.append(rows.columns) or heavy_flight_keys(rows, *clock))
    model_queries.QUERIES["score_flights"][0](spark, FOLDER)
    assert measured and not any("INBOUND_ARR_DELAY_NEW" in columns for columns in measured)
