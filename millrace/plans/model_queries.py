"""Registered graph, regression and classifier queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import classify, forest, graph, regression, sampling
from millrace.plans import derived, flights, package
from millrace.plans.table_queries import FLIGHTS, INBOUND, INDEX, STATIONS, WEATHER, clean_flights, flight_features, with_weather_sql
from millrace.session import scratch, stored
from millrace.sources.readers import table
from millrace.sources.writers import write_parquet

EDGES = """tr AS (SELECT 'c' || o_custkey AS c, 's' || l_suppkey AS s, l_linenumber = 1 AND l_suppkey % 2 = 0 AS back FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
 ed AS (SELECT src, dst, count(*) AS weight FROM (SELECT c AS src, s AS dst FROM tr UNION ALL SELECT s, c FROM tr WHERE back) GROUP BY 1, 2),
 ow AS (SELECT src, CAST(sum(weight) AS BIGINT) AS out_weight, count(*) AS links FROM ed GROUP BY 1),
 tp AS (SELECT src, dst, weight / out_weight AS p FROM ed JOIN ow USING (src)),
 nd AS (SELECT src AS node FROM ed UNION SELECT dst FROM ed)"""


def _rounded(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _rank_steps(steps: int, alpha: float = 0.15, plain: bool = False) -> str:
    """CTEs ``r0 … rN(node, rank)`` of unrolled PageRank."""
    probs = "tp"
    parts = []
    if plain:
        probs = "pp"
        parts.append("pp AS (SELECT src, dst, 1.0 / count(*) OVER (PARTITION BY src) AS p FROM ed)")
        parts.append("r0 AS (SELECT node, 1.0::DOUBLE AS rank FROM nd)")
    else:
        parts.append("r0 AS (SELECT node, 1.0::DOUBLE / (SELECT count(*) FROM nd) AS rank FROM nd)")
    for k in range(1, steps + 1):
        lost = "0" if plain else f"(SELECT sum(rank) FROM r{k - 1} WHERE node NOT IN (SELECT src FROM ow)) / (SELECT count(*) FROM nd)"
        base = f"{alpha}" if plain else f"{alpha} / (SELECT count(*) FROM nd)"
        parts.append(
            f"""r{k} AS (SELECT nd.node, {base} + {1 - alpha} * ({lost} + coalesce(g.got, 0))::DOUBLE AS rank FROM nd LEFT JOIN
 (SELECT dst, sum(rank * p) AS got FROM {probs} JOIN r{k - 1} ON src = node GROUP BY dst) g ON g.dst = nd.node)"""
        )
    return ", ".join(parts)


def _power_steps(steps: int) -> str:
    parts = ["r0 AS (SELECT node, CASE WHEN node = 'c1' THEN 1.0 ELSE 0 END::DOUBLE AS rank FROM nd)"]
    for k in range(1, steps + 1):
        parts.append(
            f"r{k} AS (SELECT node, coalesce(g.got, 0) AS rank FROM nd LEFT JOIN (SELECT dst, sum(rank * p) AS got FROM tp JOIN r{k - 1} ON src = node GROUP BY dst) g ON g.dst = node)"
        )
    return ", ".join(parts)


def _start(edges):
    return graph.nodes(edges).where("node = 'c1'").withColumn("mass", F.lit(1.0))


def _titles(spark, d):
    customers = table(spark, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey")).alias("node"), F.col("c_name").alias("title"))
    suppliers = table(spark, d, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("node"), F.col("s_name").alias("title"))
    return customers.unionByName(suppliers)


TERMS = ["quantity", "discount", "tax"]
LABEL = "price"
RATE, STEPS = 0.1, 3
PRICES = """pr AS (SELECT l_orderkey, l_quantity AS quantity, l_discount AS discount, l_tax AS tax, l_extendedprice / 1000 AS price,
   (l_orderkey % 5)::INT AS fold, l_orderkey % 10 < 8 AS is_train FROM lineitem),
 ms AS (SELECT avg(quantity) AS mq, stddev_pop(quantity) AS sq, avg(discount) AS md, stddev_pop(discount) AS sd, avg(tax) AS mt, stddev_pop(tax) AS st FROM pr WHERE is_train),
 z AS (SELECT l_orderkey, fold, is_train, price, (quantity - mq) / sq AS quantity, (discount - md) / sd AS discount, (tax - mt) / st AS tax FROM pr, ms),
 za AS (SELECT fold, price, quantity, discount, tax FROM z WHERE is_train)"""
PRED = "(w.b + w.wq * quantity + w.wd * discount + w.wt * tax)"


def _prices(spark, d):
    """Rows standardised by the training statistics."""
    rows = derived.price_rows(spark, d)
    stats = regression.feature_stats(rows.where("is_train"), TERMS)
    return regression.standardise(rows, stats)


def _train_test(spark, d):
    sums = regression.moments(_prices(spark, d), TERMS, LABEL, "is_train")
    return sums[True], sums[False]


def _path(spark, d, kind=None, strength=0.05, steps=STEPS):
    train, test = _train_test(spark, d)
    return regression.descend(train, test, regression.baseline(train), steps, RATE, kind, strength)


def _descent(kind=None, strength=0.05):
    def run(spark, d):
        history = _path(spark, d, kind, strength)
        weights = regression.model_table(spark, history, TERMS, kind or "ols")
        losses = regression.loss_table(spark, history, kind or "ols")
        wide = weights.groupBy("model", "step").pivot("term", [regression.BIAS, *TERMS]).agg(F.first("weight"))
        return _rounded(wide.join(losses, ["model", "step"]), 6, regression.BIAS, *TERMS, "train_loss", "test_loss")

    return run


def _steps_sql(kind: str | None, strength: float, steps: int = STEPS) -> str:
    """CTEs ``w0 … wN(b, wq, wd, wt)``, each from a pass over the rows."""
    parts = ["w0 AS (SELECT avg(price) AS b, 0.0::DOUBLE AS wq, 0.0::DOUBLE AS wd, 0.0::DOUBLE AS wt FROM z WHERE is_train)"]
    for k in range(1, steps + 1):
        def pull(c: str) -> str:
            if kind == "ridge":
                return f" - {RATE} * 2 * {strength} * any_value(w.{c})"
            if kind == "lasso":
                return f" - {RATE} * {strength} * sign(any_value(w.{c}))"
            return ""

        parts.append(
            f"w{k} AS (SELECT any_value(w.b) + {2 * RATE} * avg(price - {PRED}) AS b, "
            + ", ".join(
                f"any_value(w.{c}) + {2 * RATE} * avg((price - {PRED}) * {f}){pull(c)} AS {c}"
                for c, f in (("wq", "quantity"), ("wd", "discount"), ("wt", "tax"))
            )
            + f" FROM z, w{k - 1} w WHERE is_train)"
        )
    return ", ".join(parts)


def _penalty_sql(kind: str | None, strength: float) -> str:
    if kind == "ridge":
        return f"{strength} * (w.wq * w.wq + w.wd * w.wd + w.wt * w.wt)"
    if kind == "lasso":
        return f"{strength} * (abs(w.wq) + abs(w.wd) + abs(w.wt))"
    return "0"


def _descent_sql(kind: str | None = None, strength: float = 0.05) -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{kind or 'ols'}' AS model, {k} AS step, round(w.b, 6) AS bias, round(w.wq, 6) AS quantity, round(w.wd, 6) AS discount, round(w.wt, 6) AS tax,
 round((SELECT avg(pow(price - {PRED}, 2)) FROM z WHERE is_train) + {_penalty_sql(kind, strength)}, 6) AS train_loss,
 round((SELECT avg(pow(price - {PRED}, 2)) FROM z WHERE NOT is_train) + {_penalty_sql(kind, strength)}, 6) AS test_loss FROM w{k} w"""
        for k in range(1, STEPS + 1)
    )
    return f"WITH {PRICES}, {_steps_sql(kind, strength)} {rows}"


def _folds(spark, d):
    """Folds of the training rows; held-out rows take no part."""
    sums = regression.moments(_prices(spark, d).where("is_train"), TERMS, LABEL, "fold")
    whole = sum(list(sums.values())[1:], list(sums.values())[0])
    history = regression.descend_folds(sums, regression.baseline(whole), STEPS, RATE, scale=1.0)
    return spark.createDataFrame(history, "step int, train_loss double, test_loss double")


def _folds_sql() -> str:
    parts = ["w0 AS (SELECT k AS model, (SELECT avg(price) FROM za) AS b, 0.0::DOUBLE AS wq, 0.0::DOUBLE AS wd, 0.0::DOUBLE AS wt FROM range(5) t(k))"]
    for k in range(1, STEPS + 1):
        parts.append(
            f"w{k} AS (SELECT model, any_value(w.b) + {RATE} * avg(price - {PRED}) AS b, "
            + ", ".join(f"any_value(w.{c}) + {RATE} * avg((price - {PRED}) * {f}) AS {c}" for c, f in (("wq", "quantity"), ("wd", "discount"), ("wt", "tax")))
            + f" FROM za JOIN w{k - 1} w ON za.fold <> w.model GROUP BY model)"
        )
    rows = " UNION ALL ".join(
        f"""SELECT {k} AS step, round(avg(tr), 6) AS train_loss, round(avg(te), 6) AS test_loss FROM (SELECT model,
 avg(pow(price - {PRED}, 2)) FILTER (fold <> model) AS tr, avg(pow(price - {PRED}, 2)) FILTER (fold = model) AS te FROM za, w{k} w GROUP BY model)"""
        for k in range(STEPS + 1)
    )
    return f"WITH {PRICES}, {', '.join(parts)} {rows}"


def _heldout(spark, d):
    """Held-out error of the three models after ten steps."""
    train, test = _train_test(spark, d)
    rows = []
    for kind in (None, "ridge", "lasso"):
        last = regression.descend(train, test, regression.baseline(train), 10, RATE, kind, 0.05)[-1][1]
        rows.append((kind or "ols", round(test.loss(last), 6)))
    return spark.createDataFrame(rows, "model string, mse double")


def _heldout_sql() -> str:
    out = []
    for kind in (None, "ridge", "lasso"):
        out.append(
            f"""SELECT '{kind or 'ols'}' AS model, mse FROM (WITH {PRICES}, {_steps_sql(kind, 0.05, 10)}
 SELECT round(avg(pow(price - {PRED}, 2)), 6) AS mse FROM z, w10 w WHERE NOT is_train)"""
        )
    return " UNION ALL ".join(out)


def _residual_rows(spark, d, kinds=(None,)):
    """Held-out rows and the weights of each kind of model."""
    rows = _prices(spark, d)
    train = regression.moments(rows.where("is_train"), TERMS, LABEL)[None]
    paths = [regression.descend(train, None, regression.baseline(train), STEPS, RATE, kind, 0.05) for kind in kinds]
    return rows.where("NOT is_train"), [regression.weights_of(path[-1][1], TERMS) for path in paths]


def _residuals(spark, d):
    rows, (weights,) = _residual_rows(spark, d)
    return regression.residuals(rows, weights, LABEL, ["l_orderkey"]).select("l_orderkey", "price", F.round("residual", 4).alias("residual"))


KINDS = (None, "ridge", "lasso")


def _residual_box(spark, d):
    """Residuals of the three models by price bucket of ten thousand."""
    rows, weights = _residual_rows(spark, d, KINDS)
    rows = rows.withColumn("bucket", F.floor(F.col(LABEL) / 10))
    out = None
    for kind, w in zip(KINDS, weights):
        box = regression.residual_box(rows, w, LABEL, "bucket").select(F.lit(kind or "ols").alias("model"), "*")
        out = box if out is None else out.union(box)
    return _rounded(out, 4, "low", "q1", "median", "q3", "high")


def _residual_box_sql() -> str:
    """Price minus prediction, grouped by the bucket of the price."""
    return " UNION ALL ".join(
        f"""SELECT '{kind or 'ols'}' AS model, * FROM (WITH {PRICES}, {_steps_sql(kind, 0.05)},
 rs AS (SELECT CAST(floor(price / 10) AS BIGINT) AS bucket, price - {PRED} AS r FROM z, w{STEPS} w WHERE NOT is_train)
 SELECT bucket, round(min(r), 4) AS low, round(quantile_disc(r, 0.25), 4) AS q1, round(quantile_disc(r, 0.5), 4) AS median,
 round(quantile_disc(r, 0.75), 4) AS q3, round(max(r), 4) AS high, count(*) AS n FROM rs GROUP BY bucket)"""
        for kind in KINDS
    )


def _rows(spark, d, features):
    """Complete rows with the mark of a split by year."""
    return flights.labelled(sampling.time_split(flight_features(spark, d), F.col("YEAR"), 2000), features, ["is_train"])


def _metrics(kinds, features, **params):
    return lambda s, d: classify.report(_rows(s, d, features), "is_train", flights.LABEL, features, kinds, **params)


def _fitted(spark, d, features, kind, **params):
    rows = stored(_rows(spark, d, features))
    return classify.fit(rows.where("is_train"), flights.LABEL, features, kind, **params), rows.where("NOT is_train").drop("is_train")


def _importance(spark, d):
    model, _ = _fitted(spark, d, flights.BEST_SET, "rf")
    return classify.importances(model, flights.BEST_SET, spark)


def _scored(spark, d):
    model, test = _fitted(spark, d, flights.SEASON_SET, "gbt", max_iter=3)
    return classify.score(model, test)


def _roc(spark, d):
    model, test = _fitted(spark, d, flights.SEASON_SET, "lr_plain")
    return classify.roc_curve(classify.score(model, test), flights.LABEL)


def _rule(spark, d):
    """Flights scored by a fixed rule, the later in the day the riskier."""
    rows = clean_flights(spark, d).withColumn("p1", F.col("DEP_TIME") / F.lit(2400.0))
    return rows.withColumn("prediction", (F.col("p1") >= 0.7).cast("double"))


def _rule_ranking(spark, d):
    return _rounded(classify.ranking_metrics(_rule(spark, d), flights.LABEL), 9, "auroc", "auprc")


def _rule_metrics(spark, d):
    out = classify.confusion_metrics(_rule(spark, d), flights.LABEL)
    return _rounded(out, 9, *[c for c in out.columns if c != "rows"])


RULE = f"""{FLIGHTS}, sc AS (SELECT DEP_TIME / 2400.0::DOUBLE AS p1, DEP_DEL15 AS y FROM fl),
 th AS (SELECT p1, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y <> 1) AS neg FROM sc GROUP BY p1),
 cu AS (SELECT *, sum(pos) OVER (ORDER BY p1 DESC)::DOUBLE AS tp, sum(neg) OVER (ORDER BY p1 DESC)::DOUBLE AS fp FROM th),
 pt AS (SELECT *, tp / (tp + fp) AS here, coalesce(lag(tp / (tp + fp)) OVER (ORDER BY p1 DESC), tp / (tp + fp)) AS before, coalesce(lag(tp) OVER (ORDER BY p1 DESC), 0) AS tp0 FROM cu)"""
CHOSEN = [flights.LABEL, "DEP_TIME", "DAY_OF_WEEK", "MONTH", "ARR_DELAY_NEW"]


COMPLETE = f"""{FLIGHTS}, {WEATHER}, {STATIONS}, {INBOUND}, {INDEX}, fx AS MATERIALIZED (SELECT * FROM ib JOIN di USING (OP_CARRIER, ORIGIN_AIRPORT_ID)),
 complete AS (SELECT * FROM ({with_weather_sql('fx')}) WHERE {' AND '.join(c + ' IS NOT NULL' for c in flights.BEST_SET)})"""
TREE_SET = ["DEP_TIME", "DAY_OF_WEEK", "MONTH", "DAY_OF_MONTH", "ARR_DELAY_NEW"]


def _plain_rows(spark, d):
    """Numbered rows of flights without their weather."""
    rows = flights.labelled(clean_flights(spark, d), TREE_SET)
    return stored(rows.withColumn("row", F.monotonically_increasing_id()))


BALANCED = 1e-4  # greatest violation of a fitted logistic regression


def _lr_optimality(spark, d):
    """Both regressions, fitted to the end: are their weights the best ones?"""
    rows, out = _plain_rows(spark, d), None
    for kind, penalty in (("lr", {"reg": 0.02, "elastic_net": 0.8}), ("lr_plain", {})):
        params = {"regParam": penalty["reg"], "elasticNetParam": penalty["elastic_net"]} if penalty else {}
        model = classify.fit(rows, flights.LABEL, TREE_SET, kind, max_iter=500, tol=1e-10, **params)
        found = classify.optimality(model, rows, flights.LABEL, TREE_SET, **penalty)
        row = found.agg(F.lit(kind).alias("model"), F.count("*").alias("weights"), F.count_if(F.col("violation") > BALANCED).alias("off"))
        out = row if out is None else out.union(row)
    return out


def _saved_trees(spark, rows, *kinds):
    """``(kind, model, trees)`` of each ``(kind, params)``."""
    with classify.fitting(rows, flights.LABEL, TREE_SET) as fitted:
        for kind, params in kinds:
            model, path = fitted(kind, **params), scratch(spark)
            classify.save_model(model, path)
            yield kind, model, stored(forest.tree_table(spark, path))


BOTH_TREES = ("rf", {}), ("gbt", {"max_iter": 5})


def _tree_scores(spark, d):
    """Scores from the trees' table against those of the fitted models."""
    rows, out = _plain_rows(spark, d), None
    for kind, model, trees in _saved_trees(spark, rows, *BOTH_TREES):
        by_joins = {"rf": forest.forest_scores, "gbt": forest.boosted_scores}[kind]
        # the model's score goes with its row: the two need not be joined
        scored = classify.score(model, rows).withColumnRenamed("p1", "want")
        both = by_joins(scored, trees, ["row", "want"], TREE_SET, forest.depth(model))
        row = both.agg(F.lit(kind).alias("model"), F.count("*").alias("rows"), F.count_if(F.abs(F.col("p1") - F.col("want")) > 1e-9).alias("differing"))
        out = row if out is None else out.union(row)
    return out


def _tree_importance(spark, d):
    """Importances from the gains in the trees' table against MLlib's."""
    rows, out = _plain_rows(spark, d), None
    for kind, model, trees in _saved_trees(spark, rows, *BOTH_TREES):
        own = forest.gain_importances(trees, TREE_SET, per_tree=kind == "rf")
        both = classify.importances(model, TREE_SET, spark).join(own.withColumnRenamed("importance", "own"), "feature", "left")
        off = F.abs(F.col("importance") - F.coalesce("own", F.lit(0.0))) > 1e-9
        row = both.agg(F.lit(kind).alias("model"), F.count("*").alias("features"), F.count_if(off).alias("differing"))
        out = row if out is None else out.union(row)
    return out


def _tree_rows(spark, d):
    """Training rows that meet in each tree's root: all of them, for boosting
    draws none."""
    rows = _plain_rows(spark, d)
    ((_, _, trees),) = _saved_trees(spark, rows, ("gbt", {"max_iter": 3}))
    return trees.where("node = 0").select("tree", F.col("held").cast("bigint").alias("rows"))


def _report_rows(spark, d):
    """The part of a report that does not depend on how a model was fitted,
    and whether its metrics agree with each other."""
    rows = flights.labelled(sampling.time_split(clean_flights(spark, d), F.col("YEAR"), 2000), TREE_SET, ["is_train"])
    found = classify.report(rows, "is_train", flights.LABEL, TREE_SET, ["lr", "lr_plain", "rf", "gbt"], max_iter=3)
    hits = F.col("recall") * F.col("positive_rate") + (1 - F.col("false_positive_rate")) * (1 - F.col("positive_rate"))
    agree = (F.abs(hits - F.col("accuracy")) < 1e-9) & F.col("auroc").between(0, 1) & F.col("auprc").between(0, 1) & (F.col("recall") == F.col("true_positive_rate"))
    return found.select("model", "rows", F.round("positive_rate", 9).alias("positive_rate"), agree.cast("int").alias("agree"))


def _train_best(spark, d):
    """The job's best model: 30 boosted trees on 23 features."""
    model, test = flights.train_best(flight_features(spark, d), 2000)
    scored = classify.score(model, test)
    size = {"trees": model.stages[-1].getNumTrees, "features": model.stages[-1].numFeatures}
    return scored.agg(*[F.lit(n).alias(k) for k, n in size.items()], F.count("*").alias("test_rows"), F.count_if(F.col("p1").between(0, 1)).alias("scored"))


def _score_flights(spark, d):
    """A package is published, one day's file scored, then all days': the
    second batch takes up the two days that are left."""
    folder, out = scratch(spark), scratch(spark)
    raw, weather_files = derived.raw_flights(spark, d), scratch(spark)
    days = [f"2024-01-0{i}" for i in (1, 2, 3)]
    for day in days:
        write_parquet(raw.where(F.col("FL_DATE") == day), f"{out}/in/{day}")
    write_parquet(derived.raw_weather(spark, d), weather_files)
    known = clean_flights(spark, d)
    index = stored(flights.delay_index(known.where("YEAR = 1999")))
    stations = stored(flights.station_index(flights.clean_weather(derived.raw_weather(spark, d)), derived.airport_rows(spark, d)))
    heavy = flights.heavy_flight_keys(known)  # else the legs would be joined once more, to measure the rows with them
    legs = flights.attach_delay_index(flights.attach_inbound(known, heavy=heavy), index)
    rows = flights.attach_weather(legs, flights.clean_weather(derived.raw_weather(spark, d)), stations, heavy)
    train = stored(flights.labelled(rows, flights.BEST_SET))
    model = classify.fit(train, flights.LABEL, flights.BEST_SET, "gbt", max_iter=3)
    package.publish(spark, folder, model, index, stations, flights.BEST_SET)
    batches = [package.score_new(spark, folder, [f"{out}/in/{day}" for day in some], weather_files, f"{out}/scored", ["FL_DATE"]) for some in (days[:1], days, days)]
    if batches[2] is not None:
        raise RuntimeError("a file was scored twice")
    return package.scores(spark, f"{out}/scored").groupBy("FL_DATE").agg(F.count("*").alias("scored"), F.round(F.avg(flights.LABEL), 6).alias("late"))


QUERIES = {
    "graph_edges": (derived.trade_edges, f"WITH {EDGES} SELECT src, dst, weight FROM ed"),
    "graph_nodes": (lambda s, d: graph.node_count(derived.trade_edges(s, d)), f"WITH {EDGES} SELECT count(*) AS nodes FROM nd"),
    "graph_dangling": (
        lambda s, d: graph.dangling_count(derived.trade_edges(s, d)),
        f"WITH {EDGES} SELECT count(*) AS nodes, count(*) FILTER (node NOT IN (SELECT src FROM ow)) AS dangling FROM nd",
    ),
    "graph_dangling_nodes": (
        lambda s, d: graph.dangling(derived.trade_edges(s, d)),
        f"WITH {EDGES} SELECT node FROM nd WHERE node NOT IN (SELECT src FROM ow)",
    ),
    "out_degree_top": (
        lambda s, d: graph.degree_report(derived.trade_edges(s, d))[0],
        f"WITH {EDGES} SELECT * FROM ow ORDER BY out_weight DESC, src LIMIT 10",
    ),
    "out_degree_mean": (
        lambda s, d: _rounded(graph.degree_report(derived.trade_edges(s, d))[1], 6, "mean_out_weight"),
        f"WITH {EDGES} SELECT round(avg(out_weight), 6) AS mean_out_weight FROM ow",
    ),
    "adjacency_list": (
        lambda s, d: graph.adjacency_list(stored(derived.trade_edges(s, d)), part=20).select(
            "src", "part", F.array_join(F.transform("neighbours", lambda e: F.concat(e.dst, F.lit(":"), e.weight)), " ").alias("neighbours")
        ),
        f"""WITH {EDGES}, sl AS (SELECT src, dst, weight, (('0x' || substr(md5('42|' || dst), 1, 8))::BIGINT % greatest(ceil(links / 20), 1)::BIGINT)::INT AS part FROM ed JOIN ow USING (src))
 SELECT src, part, string_agg(dst || ':' || weight, ' ' ORDER BY dst) AS neighbours FROM sl GROUP BY src, part""",
    ),
    "adjacency_matrix": (
        lambda s, d: graph.adjacency_matrix(derived.trade_edges(s, d)),
        f"WITH {EDGES} SELECT src, dst, 1 AS value FROM ed",
    ),
    "transition_prob": (
        lambda s, d: _rounded(graph.transitions(stored(derived.trade_edges(s, d))), 9, "p"),
        f"WITH {EDGES} SELECT src, dst, round(p, 9) AS p FROM tp",
    ),
    "initial_ranks": (
        lambda s, d: _rounded(graph.initial_ranks(derived.trade_edges(s, d)), 9, "rank"),
        f"WITH {EDGES} SELECT node, coalesce(links, 0) AS links, round(1.0::DOUBLE / (SELECT count(*) FROM nd), 9) AS rank FROM nd LEFT JOIN ow ON src = node",
    ),
    "power_iteration_3": (
        lambda s, d: (lambda edges: _rounded(graph.power_iteration(edges, _start(edges), 3), 9, "mass"))(derived.trade_edges(s, d)),
        f"WITH {EDGES}, {_power_steps(3)} SELECT node, round(rank, 9) AS mass FROM r3",
    ),
    "pagerank_3": (
        lambda s, d: _rounded(graph.pagerank(derived.trade_edges(s, d), iterations=3), 9, "rank"),
        f"WITH {EDGES}, {_rank_steps(3)} SELECT node, round(rank, 9) AS rank FROM r3",
    ),
    "pagerank_unnormalised_3": (
        lambda s, d: _rounded(graph.pagerank_unnormalised(derived.trade_edges(s, d), iterations=3), 7, "rank"),
        f"WITH {EDGES}, {_rank_steps(3, plain=True)} SELECT node, round(rank, 7) AS rank FROM r3",
    ),
    "pagerank_top_named": (
        lambda s, d: _rounded(graph.top_ranked_named(graph.pagerank(derived.trade_edges(s, d), iterations=3), _titles(s, d)), 9, "rank"),
        f"""WITH {EDGES}, {_rank_steps(3)}, tt AS (SELECT 'c' || c_custkey AS node, c_name AS title FROM customer UNION ALL SELECT 's' || s_suppkey, s_name FROM supplier)
 SELECT node, title, round(rank, 9) AS rank FROM (SELECT * FROM r3 ORDER BY rank DESC, node LIMIT 20) JOIN tt USING (node)""",
    ),
    "pagerank_mass": (
        lambda s, d: graph.pagerank_mass(derived.trade_edges(s, d), iterations=3).select("iteration", F.round("mass", 9).alias("mass"), F.round("dangling_mass", 9).alias("dangling_mass")),
        f"WITH {EDGES}, {_rank_steps(3)} "
        + " UNION ALL ".join(
            f"SELECT {k} AS iteration, round(sum(rank), 9) AS mass, round(sum(rank) FILTER (node NOT IN (SELECT src FROM ow)), 9) AS dangling_mass FROM r{k}"
            for k in (1, 2, 3)
        ),
    ),
    "label_stats": (
        lambda s, d: _rounded(regression.label_stats(derived.price_rows(s, d), LABEL), 6, "mean", "variance"),
        "SELECT round(avg(l_extendedprice / 1000), 6) AS mean, round(var_pop(l_extendedprice / 1000), 6) AS variance FROM lineitem",
    ),
    "standardise": (
        lambda s, d: _rounded(_prices(s, d), 6, *TERMS).select("l_orderkey", *TERMS),
        f"WITH {PRICES} SELECT l_orderkey, round(quantity, 6) AS quantity, round(discount, 6) AS discount, round(tax, 6) AS tax FROM z",
    ),
    "ols_baseline_loss": (
        lambda s, d: (lambda m: s.createDataFrame([(round(m.loss(regression.baseline(m)), 6),)], "loss double"))(
            regression.moments(_prices(s, d).where("is_train"), TERMS, LABEL)[None]
        ),
        f"WITH {PRICES} SELECT round(var_pop(price), 6) AS loss FROM z WHERE is_train",
    ),
    "ols_gd_3": (_descent(), _descent_sql()),
    "ridge_gd_3": (_descent("ridge"), _descent_sql("ridge")),
    "lasso_gd_3": (_descent("lasso"), _descent_sql("lasso")),
    "cv_loss": (lambda s, d: _rounded(_folds(s, d), 6, "train_loss", "test_loss"), _folds_sql()),
    "heldout_mse": (_heldout, _heldout_sql()),
    "residuals": (
        _residuals,
        f"WITH {PRICES}, {_steps_sql(None, 0)} SELECT l_orderkey, price, round(price - {PRED}, 4) AS residual FROM z, w{STEPS} w WHERE NOT is_train",
    ),
    "residual_box": (_residual_box, _residual_box_sql()),
    "chosen_features": (
        lambda s, d: classify.keep_columns(clean_flights(s, d), CHOSEN[0], CHOSEN[1:]),
        f"WITH {FLIGHTS} SELECT {', '.join(CHOSEN)} FROM fl",
    ),
    "rule_metrics": (
        _rule_metrics,
        f"""WITH {RULE}, cm AS (SELECT count(*) AS rows, avg(y) AS positive_rate, count(*) FILTER (y = 1 AND p1 >= 0.7) AS tp, count(*) FILTER (y <> 1 AND p1 < 0.7) AS tn,
 count(*) FILTER (y <> 1 AND p1 >= 0.7) AS fp, count(*) FILTER (y = 1 AND p1 < 0.7) AS fn FROM sc)
 SELECT rows, round(positive_rate, 9) AS positive_rate, round((tp + tn) / rows, 9) AS accuracy, round(2 * tp / (2 * tp + fp + fn), 9) AS f1, round(tp / (tp + fp), 9) AS precision,
 round(tp / (tp + fn), 9) AS recall, round(fp / (fp + tn), 9) AS false_positive_rate, round(tp / (tp + fn), 9) AS true_positive_rate FROM cm""",
    ),
    "rule_ranking": (
        _rule_ranking,
        f"""WITH {RULE} SELECT round(sum(neg * (tp + tp0) / 2) / (max(tp) * max(fp)), 9) AS auroc, round(sum(pos * (here + before) / 2) / max(tp), 9) AS auprc FROM pt""",
    ),
    "rule_roc_curve": (
        lambda s, d: _rounded(classify.roc_curve(_rule(s, d), flights.LABEL), 9, "FPR", "TPR"),
        f"""WITH {RULE} SELECT round(fp / (SELECT max(fp) FROM cu), 9) AS FPR, round(tp / (SELECT max(tp) FROM cu), 9) AS TPR FROM cu UNION ALL SELECT 0.0, 0.0""",
    ),
    "lr_metrics": (_metrics(["lr", "lr_plain"], flights.WEATHER_SET), None),
    "rf_metrics": (_metrics(["rf"], flights.SEASON_SET), None),
    "gbt_metrics": (_metrics(["gbt"], flights.BEST_SET), None),
    "model_report": (_metrics(["lr", "lr_plain", "rf", "gbt"], flights.INDEX_SET, max_iter=5), None),
    "rf_importance": (_importance, None),
    "batch_scores": (_scored, None),
    "lr_roc_curve": (_roc, None),
    "lr_optimality": (
        _lr_optimality,
        f"SELECT unnest(['lr', 'lr_plain']) AS model, {len(TREE_SET) + 1} AS weights, 0 AS off",
    ),
    "tree_scores": (
        _tree_scores,
        f"WITH {FLIGHTS} SELECT model, count(*) AS rows, 0 AS differing FROM fl, (SELECT unnest(['rf', 'gbt']) AS model) GROUP BY model",
    ),
    "tree_importance": (_tree_importance, f"SELECT unnest(['rf', 'gbt']) AS model, {len(TREE_SET)} AS features, 0 AS differing"),
    "tree_root_rows": (_tree_rows, f"WITH {FLIGHTS} SELECT tree, count(*) AS rows FROM fl, range(3) t(tree) GROUP BY tree"),
    "model_report_rows": (
        _report_rows,
        f"""WITH {FLIGHTS} SELECT model, count(*) AS rows, round(avg(DEP_DEL15), 9) AS positive_rate, 1 AS agree
 FROM fl, (SELECT unnest(['lr', 'lr_plain', 'rf', 'gbt']) AS model) WHERE YEAR >= 2000 GROUP BY model""",
    ),
    "train_best": (
        _train_best,
        f"""WITH {COMPLETE} SELECT 30 AS trees, {len(flights.BEST_SET)} AS features, count(*) AS test_rows, count(*) AS scored FROM complete WHERE YEAR >= 2000""",
    ),
    "score_flights": (
        _score_flights,
        f"WITH {COMPLETE} SELECT FL_DATE, count(*) AS scored, round(avg(DEP_DEL15), 6) AS late FROM complete GROUP BY FL_DATE",
    ),
    "out_degree_sample": (
        lambda s, d: graph.degree_report(derived.trade_edges(s, d), sample=500)[2],
        f"WITH {EDGES} SELECT * FROM ow ORDER BY ('0x' || substr(md5('42|' || src), 1, 8))::BIGINT, src LIMIT 500",
    ),
}
