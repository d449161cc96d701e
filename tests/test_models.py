import numpy as np
import pytest
from pyspark.sql import functions as F

from results import rows
from millrace.operators import classify, graph, regression

ONE = "AB AD BC BE CD DE EA EB EC".split()
TWO = "AB AC AD BD BE CA CE DB".split()


def edges(spark, pairs):
    return spark.createDataFrame([(a, b, 1) for a, b in pairs], "src string, dst string, weight long")


def ranks(df, col="rank"):
    return {r.node: r[col] for r in df.collect()}


def test_adjacency_lines(spark):
    lines = spark.createDataFrame([("1\t{'2': 1, '3': 4}",), ("4\t{}",), ("3\t{'2': 2}",)], "value string")
    e = graph.edges_from_adjacency(lines)
    assert rows(e) == {("1", "2", 1), ("1", "3", 4), ("3", "2", 2)}
    assert rows(graph.sources_from_adjacency(lines)) == {("1",), ("3",), ("4",)}
    assert tuple(graph.dangling_count(e).first()) == (3, 1)
    assert graph.node_count(e).first()[0] == 3
    assert rows(graph.out_weights(e)) == {("1", 5, 2), ("3", 2, 1)}
    assert rows(graph.transitions(e)) == {("1", "2", 0.2), ("1", "3", 0.8), ("3", "2", 1.0)}
    top, mean, sample = graph.degree_report(e, 1)
    assert top.first().src == "1" and mean.first()[0] == 3.5 and sample.count() == 2


def test_graph_shapes(spark):
    e = edges(spark, TWO)
    assert {r.src: [x.dst for x in r.neighbours] for r in graph.adjacency_list(e).collect()} == {"A": list("BCD"), "B": list("DE"), "C": list("AE"), "D": ["B"]}
    assert sum(len(r.neighbours) for r in graph.adjacency_list(e, part=1).collect()) == 8
    wide = {r.src: (r.A, r.E) for r in graph.adjacency_matrix(e, ["A", "E"]).collect()}
    assert wide["C"] == (1, 1) and wide["D"] == (0, 0)
    assert rows(graph.dangling(e)) == {("E",)}
    assert {(r.node, r.links, round(r["rank"], 6)) for r in graph.initial_ranks(e).collect()} >= {("E", 0, 0.2), ("A", 3, 0.2)}


def test_stationary_distribution(spark):
    got = ranks(graph.pagerank(edges(spark, ONE), alpha=0.0, iterations=200, tol=1e-9))
    want = {"A": 0.10526316, "B": 0.15789474, "C": 0.18421053, "D": 0.23684211, "E": 0.31578947}
    assert got == {k: pytest.approx(v, abs=1e-7) for k, v in want.items()}


def test_pagerank_with_dangling_node(spark):
    got = ranks(graph.pagerank(edges(spark, TWO), iterations=20))
    want = {"A": 0.11592031, "B": 0.30235992, "C": 0.10439602, "D": 0.23289973, "E": 0.24442402}
    assert got == {k: pytest.approx(v, abs=1e-7) for k, v in want.items()}
    mass = graph.pagerank_mass(edges(spark, TWO), iterations=4).collect()
    assert [r.iteration for r in mass] == [1, 2, 3, 4] and all(r.mass == pytest.approx(1) for r in mass)


def test_power_iteration_leaks(spark):
    start = spark.createDataFrame([("A", 1.0)], "node string, mass double")
    got = graph.power_iteration(edges(spark, TWO), start, 10)
    assert sum(r.mass for r in got.collect()) == pytest.approx(0.0625)


def test_weighted_links_and_heavy_source(spark):
    """One source owns half of the links; parallel links add up."""
    pairs = [("hub", f"n{i}") for i in range(200)] + [(f"n{i}", f"n{(i * 7 + 1) % 200}") for i in range(200)] + [("n0", "n1")] * 3
    e = edges(spark, pairs)
    got = ranks(graph.pagerank(e, iterations=5))
    names = ["hub", *[f"n{i}" for i in range(200)]]
    at = {n: i for i, n in enumerate(names)}
    m = np.zeros((201, 201))
    for a, b in pairs:
        m[at[a], at[b]] += 1
    p = m / m.sum(axis=1, keepdims=True)
    r = np.full(201, 1 / 201)
    for _ in range(5):
        r = 0.15 / 201 + 0.85 * (r @ p)
    assert got == {n: pytest.approx(r[i], abs=1e-12) for n, i in at.items()}


def test_unnormalised_ranks_start_at_one(spark):
    got = ranks(graph.pagerank_unnormalised(edges(spark, ONE), iterations=1))
    assert got["A"] == pytest.approx(0.15 + 0.85 / 3) and sum(got.values()) == pytest.approx(5)


def test_top_ranked_named(spark):
    titles = spark.createDataFrame([(c, f"Page {c}") for c in "ABCDE"], "node string, title string")
    got = graph.top_ranked_named(graph.pagerank(edges(spark, TWO), iterations=3), titles, 2).collect()
    assert [r.title for r in got][0] == "Page B" and len(got) == 2


POINTS = [(1.0, 2.0), (3.0, 4.0), (5.0, 5.0), (4.0, 3.0), (2.0, 3.0)]


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(POINTS, "x double, y double").cache()


def test_baseline_and_fit(points):
    m = regression.moments(points, ["x"], "y")[None]
    w = regression.baseline(m)
    assert w[0] == pytest.approx(3.4) and m.loss(w) == pytest.approx(1.04)
    assert tuple(regression.label_stats(points, "y").first()) == (pytest.approx(3.4), pytest.approx(1.04))
    best = np.linalg.solve(m.xx, m.xy)
    assert best == pytest.approx([1.6, 0.6]) and m.loss(best) == pytest.approx(0.32)


def test_moment_steps_equal_data_passes(points):
    m = regression.moments(points, ["x"], "y")[None]
    w, weights = regression.baseline(m), {"": 3.4, "x": 0.0}
    for _ in range(4):
        w = regression.step(m, w, 0.02)
        weights = regression.data_pass_step(points, weights, "y", 0.02)
        assert weights[""] == pytest.approx(w[0], abs=1e-9) and weights["x"] == pytest.approx(w[1], abs=1e-9)
        assert regression.mean_squared_error(points, weights, "y").first()[0] == pytest.approx(m.loss(w), abs=1e-9)


def test_penalties():
    xx, xy = np.array([[4.0, 2.0], [2.0, 6.0]]), np.array([8.0, 5.0])
    m = regression.Moments(4.0, xx, xy, 20.0)
    w = np.array([1.0, -2.0])
    grad = 2 * (xx @ w - xy) / 4
    assert regression.step(m, w, 0.1, "ridge", 0.5) == pytest.approx(w - 0.1 * (grad + [0, 2 * 0.5 * -2]))
    assert regression.step(m, w, 0.1, "lasso", 0.5) == pytest.approx(w - 0.1 * (grad + [0, -0.5]))
    assert regression.penalty(w, "ridge", 0.5) == 2 and regression.penalty(w, "lasso", 0.5) == 1 and regression.penalty(w, None, 1) == 0
    with pytest.raises(ValueError):
        regression.step(m, w, 0.1, "other")


def test_folds_match_plain_numpy(spark):
    rng = np.random.default_rng(0)
    x, y, fold = rng.normal(size=(60, 2)), rng.normal(size=60), np.arange(60) % 3
    df = spark.createDataFrame([(float(a), float(b), float(c), int(k)) for (a, b), c, k in zip(x, y, fold)], "a double, b double, y double, fold int")
    got = regression.descend_folds(regression.moments(df, ["a", "b"], "y", "fold"), np.array([y.mean(), 0, 0]), 3, 0.1, scale=1.0)
    full = np.hstack([np.ones((60, 1)), x])
    models = {k: np.array([y.mean(), 0, 0]) for k in range(3)}
    for step, train, test in got:
        if step:
            models = {k: w - 0.1 * ((full[fold != k] @ w - y[fold != k])[:, None] * full[fold != k]).mean(axis=0) for k, w in models.items()}
        assert train == pytest.approx(np.mean([((full[fold != k] @ w - y[fold != k]) ** 2).mean() for k, w in models.items()]))
        assert test == pytest.approx(np.mean([((full[fold == k] @ w - y[fold == k]) ** 2).mean() for k, w in models.items()]))


def test_scaling_and_tables(spark, points):
    stats = regression.feature_stats(points, ["x"])
    assert stats["x"] == (pytest.approx(3), pytest.approx(2**0.5))
    scaled = regression.standardise(points, stats)
    m = regression.moments(scaled, ["x"], "y")[None]
    history = regression.descend(m, m, regression.baseline(m), 30)
    assert history[-1][2] == pytest.approx(0.32, abs=1e-3)
    paths = regression.model_table(spark, history, ["x"], "ols")
    assert paths.count() == 60 and regression.loss_table(spark, history, "ols").count() == 30
    weights = regression.weights_of(history[-1][1], ["x"])
    assert regression.residuals(scaled, weights, "y").agg(F.abs(F.avg("residual"))).first()[0] < 1e-9
    assert regression.residual_box(scaled, weights, "y").count() == 4
    const = spark.createDataFrame([(1.0,), (1.0,)], "c double")
    assert rows(regression.standardise(const, regression.feature_stats(const, ["c"]))) == {(0.0,)}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 2))
    y = (x[:, 0] + 0.3 * rng.normal(size=600) > 0).astype(float)
    return spark.createDataFrame([(float(a), float(b), float(c), i < 450) for i, ((a, b), c) in enumerate(zip(x, y))], "u double, v double, y double, train boolean").cache()


def test_report_beats_chance(labelled):
    got = {r.model: r for r in classify.report(labelled, "train", "y", ["u", "v"], ["lr", "lr_plain", "rf", "gbt"], max_iter=5).collect()}
    for kind in ("lr_plain", "rf", "gbt"):
        r = got[kind]
        assert r.auroc > 0.9 and r.auprc > 0.9 and r.accuracy > 0.8 and r.rows == 150
        assert r.recall == r.true_positive_rate and 0 <= r.false_positive_rate < 0.3
    assert got["lr"].auroc >= 0.5


def test_save_score_and_importance(spark, labelled, tmp_path):
    model = classify.fit(labelled.where("train"), "y", ["u", "v"], "rf")
    classify.save_model(model, str(tmp_path / "m"))
    scored = classify.score(classify.load_model(str(tmp_path / "m")), labelled.where("NOT train"))
    assert scored.columns == ["u", "v", "y", "train", "prediction", "p1"] and scored.where("p1 < 0 or p1 > 1").count() == 0
    got = classify.importances(model, ["u", "v"], spark).collect()
    assert got[0].feature == "u" and sum(r.importance for r in got) == pytest.approx(1)
    roc = classify.roc_curve(classify.score(classify.fit(labelled, "y", ["u", "v"], "lr_plain"), labelled), "y")
    assert roc.columns == ["FPR", "TPR"] and roc.count() > 2
    with pytest.raises(ValueError):
        classify.estimator("svm", "y")


def test_confusion_metrics(spark):
    data = [(1.0, 1.0)] * 3 + [(0.0, 0.0)] * 4 + [(0.0, 1.0)] * 1 + [(1.0, 0.0)] * 2
    r = classify.confusion_metrics(spark.createDataFrame(data, "y double, prediction double"), "y").first()
    assert (r.accuracy, r.precision, r.recall, r.false_positive_rate) == (0.7, 0.75, 0.6, 0.2)
    assert r.f1 == pytest.approx(2 * 0.75 * 0.6 / 1.35)


def test_held_out_rows_leave_cross_validation_alone(spark):
    from millrace.plans import model_queries as queries

    def folds(change):
        rows = spark.range(400).select(
            F.col("id").alias("l_orderkey"), (F.col("id") % 7).alias("quantity"), (F.col("id") % 11).alias("discount"), (F.col("id") % 5).alias("tax"),
            ((F.col("id") % 13) + F.when(F.col("id") % 10 >= 8, change).otherwise(0)).alias("price"), (F.col("id") % 5).cast("int").alias("fold"), (F.col("id") % 10 < 8).alias("is_train"),
        )
        stats = regression.feature_stats(rows.where("is_train"), queries.TERMS)
        sums = regression.moments(regression.standardise(rows, stats).where("is_train"), queries.TERMS, "price", "fold")
        return regression.descend_folds(sums, regression.baseline(sum(list(sums.values())[1:], sums[0])), 3, 0.1, scale=1.0)

    assert folds(0) == folds(1000)


def test_residual_box_subtracts_from_the_label(spark):
    df = spark.createDataFrame([(10.0, 1.0, "a"), (14.0, 2.0, "a"), (30.0, 3.0, "b")], "price double, x double, bucket string")
    got = {r.bucket: (r.low, r.median, r.high) for r in regression.residual_box(df, {"": 1.0, "x": 2.0}, "price", "bucket").collect()}
    assert got == {"a": (7.0, 7.0, 9.0), "b": (23.0, 23.0, 23.0)}


def test_ranking_metrics_by_hand(spark):
    scored = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.4, 1), (0.1, 0)], "p1 double, y int")
    r = classify.ranking_metrics(scored, "y").first()
    # of six (positive, negative) pairs: 0.9 beats both, 0.8 ties one and beats one, 0.4 beats one
    assert r.auroc == pytest.approx((2 + 1.5 + 1) / 6)
    assert r.auprc == pytest.approx(1 / 3 * 1 + 1 / 3 * (1 + 2 / 3) / 2 + 1 / 3 * (2 / 3 + 3 / 4) / 2)
    curve = {(x.FPR, round(x.TPR, 6)) for x in classify.roc_curve(scored, "y").collect()}
    assert curve == {(0.0, 0.0), (0.0, 0.333333), (0.5, 0.666667), (0.5, 1.0), (1.0, 1.0)}
    assert classify.ranking_metrics(scored.limit(0), "y").first().auroc is None


def test_empty_graph_has_no_ranks(spark):
    assert graph.pagerank(spark.createDataFrame([], "src string, dst string, weight long")).count() == 0


def test_repeated_links_are_merged_once(spark, monkeypatch):
    plans, keep = [], graph.stored
    monkeypatch.setattr(graph, "stored", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(df))
    edges = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "a"), ("a", "c")], "src string, dst string").withColumn("weight", F.lit(1))
    ranks = {r.node: r.rank for r in graph.pagerank_unnormalised(edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight")), iterations=1).collect()}
    assert ranks == pytest.approx({"a": 1.0, "b": 0.575, "c": 0.575})
    assert max(p.count("Aggregate [src") for p in plans) == 1


def test_training_rows_come_in_portions(spark, monkeypatch):
    rows = spark.createDataFrame([(float(i % 2), float(i), float(i * i), i) for i in range(100)], "y double, a double, b double, other long").coalesce(1)
    assert classify.portioned(rows, "y", ["a", "b"]).rdd.getNumPartitions() == 1
    monkeypatch.setattr(classify, "ROWS_PER_TASK", 10)
    seen = []
    keep = classify.Pipeline.fit
    monkeypatch.setattr(classify.Pipeline, "fit", lambda self, train: seen.append(train) or keep(self, train))
    model = classify.fit(rows, "y", ["a", "b"], "gbt", max_iter=2)
    assert seen[0].rdd.getNumPartitions() == 10
    assert sorted(seen[0].collect()) == sorted(rows.select("y", "a", "b").collect())
    assert classify.score(model, rows).count() == 100


def test_training_rows_are_dealt_once(spark, monkeypatch):
    """For all models of a report, and let go when it is made."""
    rows = spark.createDataFrame([(float(i % 3 == 0), float(i), float(i * i), i % 5 > 0) for i in range(200)], "y double, a double, b double, train boolean")
    dealt, keep = [], classify.portioned
    monkeypatch.setattr(classify, "portioned", lambda *a: dealt.append(keep(*a)) or dealt[-1])
    held, fit = [], classify.Pipeline.fit
    monkeypatch.setattr(classify.Pipeline, "fit", lambda self, train: held.append(train.storageLevel.useDisk) or fit(self, train))
    found = classify.report(rows, "train", "y", ["a", "b"], ["lr_plain", "rf", "gbt"], max_iter=2)
    assert [r.rows for r in found.collect()] == [40, 40, 40]
    assert len(dealt) == 1 and held == [True] * 3
    assert not dealt[0].storageLevel.useDisk
