"""Registered profiling, cleaning, join, flight and sampling queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from millrace.functions import clean
from millrace.operators import counting, joins, nearest, profile, sampling, skew
from millrace.plans import derived, flights
from millrace.sources.readers import literal, query, table


def _rounded(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _lines(spark, d):
    return table(spark, d, "lineitem")


def _gappy(spark, d):
    """Documents' attributes with some values blanked or nulled."""
    return table(spark, d, "documents").select(
        "doc_id",
        clean.blank_to_null(F.when(F.col("lang") == "de", "  ").otherwise(F.col("lang"))).alias("lang"),
        F.when(F.col("source") == "src0", " ").otherwise(F.col("source")).alias("source"),
        F.when(F.col("n_chars") % 2 == 0, F.col("n_chars")).alias("n_chars"),
    )


GAPPY = """gappy AS (SELECT doc_id, CASE WHEN lang <> 'de' THEN lang END AS lang, CASE WHEN source = 'src0' THEN ' ' ELSE source END AS source,
 CASE WHEN n_chars % 2 = 0 THEN n_chars END AS n_chars FROM documents)"""


def _counts_sql(table_name: str, cols: list[str], expr: str, name: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {expr.format(c=c)} AS {name} FROM {table_name}" for c in cols)


def _dims():
    return {
        "year": F.year("l_shipdate"),
        "quarter": F.quarter("l_shipdate"),
        "month": F.month("l_shipdate"),
        "day": F.dayofmonth("l_shipdate"),
        "weekday": F.dayofweek("l_shipdate"),
        "line": F.col("l_linenumber"),
        "supplier": F.col("l_suppkey"),
    }


DIM_SQL = {
    "year": "year(l_shipdate)", "quarter": "quarter(l_shipdate)", "month": "month(l_shipdate)", "day": "day(l_shipdate)",
    "weekday": "dayofweek(l_shipdate) + 1", "line": "l_linenumber", "supplier": "l_suppkey",
}
RATES_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS dimension, CAST({e} AS VARCHAR) AS value, round(avg((l_returnflag = 'R')::INT), 6) AS rate, count(*) AS n FROM lineitem GROUP BY ALL"
    for n, e in DIM_SQL.items()
)
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
STATS_SQL = """count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, min({c}) AS low, quantile_disc({c}, 0.25) AS q1,
 quantile_disc({c}, 0.5) AS median, quantile_disc({c}, 0.75) AS q3, max({c}) AS high"""

MONEY_KEYS = ["l_suppkey", "l_returnflag"]
MONEY = ["l_quantity", "l_discount", "l_tax"]

EVENT_TIMES = """ev AS (SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day, hour(ts) AS hour, hour(ts) * 60 + minute(ts) AS minute FROM events)"""


def _events(spark, d):
    return table(spark, d, "events").select(
        "event_id", "user_id", "event_type", "value", clean.date_part("ts").alias("day"), clean.hour_part("ts").alias("hour"),
        (F.hour("ts") * 60 + F.minute("ts")).alias("minute"),
    )


def _hourly(spark, d):
    """Purchases with the errors of the same user, day and hour."""
    events = _events(spark, d)
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "day", "hour")
    errors = events.where("event_type = 'error'").select("user_id", "day", "hour", "event_id", "value")
    keys = {k: k for k in ("user_id", "day", "hour")}
    joined = joins.hourly_lookup(bought, errors, keys, {"event_id": "error_id", "value": "error_value"}, ["event_id"])
    return joined.select("event_id", "error_id", "error_value")


def _earlier(spark, d):
    """Every event with the same user's events two to four hours before it."""
    events = _events(spark, d).select("event_id", "user_id", "day", "minute")
    before = events.select("user_id", "day", F.col("event_id").alias("earlier_id"), F.col("minute").alias("earlier_minute"))
    return joins.window_self_join(events, before, ["user_id", "day"], "minute", "earlier_minute", 120, 240, ["event_id"]).select("event_id", "earlier_id")


def _earlier_summary(spark, d):
    """The same window as one row per event: count, mean and largest value."""
    events = _events(spark, d).select("event_id", "user_id", "day", "minute")
    before = _events(spark, d).select("user_id", "day", F.col("minute").alias("earlier_minute"), "value")
    out = joins.window_self_summary(events, before, ["user_id", "day"], "minute", "earlier_minute", 120, 240, "value", ["event_id"])
    return out.select("event_id", "matches", F.round("mean_value", 6).alias("mean_value"), "max_value")


def _two_roles(spark, d):
    """Order lines with the nations of customer and supplier."""
    lines = _lines(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("buyer"))
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("seller"))
    base = lines.join(orders, "l_orderkey").join(customers, "o_custkey").join(suppliers, "l_suppkey")
    nations = table(spark, d, "nation")
    out = joins.role_lookup(base, nations, "buyer", "n_nationkey", {"n_name": "buyer_nation"})
    out = joins.role_lookup(out, nations, "seller", "n_nationkey", {"n_name": "seller_nation"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "buyer_nation", "seller_nation")


def _indexed_lines(spark, d):
    lines = _lines(spark, d).select("l_orderkey", "l_partkey", *MONEY_KEYS, "l_quantity")
    index = profile.group_means(lines, MONEY_KEYS, ["l_quantity"])
    out = joins.attach_group_index(lines, index, MONEY_KEYS)
    return out.select("l_orderkey", "l_partkey", F.round(F.col("l_quantity") - F.col("MEAN_l_quantity"), 6).alias("above_mean"))


def _customer_points(spark, d):
    return table(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") / 100).alias("x"), (F.col("c_nationkey") * 4.0).alias("y"))


def _nearest_supplier(spark, d):
    sites = table(spark, d, "supplier").select("s_suppkey", (F.col("s_acctbal") / 100).alias("x"), (F.col("s_nationkey") * 4.0).alias("y"))
    return _rounded(nearest.nearest_site(_customer_points(spark, d), sites, "c_custkey", "s_suppkey", "x", "y"), 6, "distance")


def _nearest_on_sphere(spark, d):
    """Each airport's nearest station along the sphere."""
    airports = derived.airport_rows(spark, d).groupBy("AIRPORT_ID").agg(F.avg("LATITUDE").alias("LATITUDE"), F.avg("LONGITUDE").alias("LONGITUDE"))
    stations = clean_weather(spark, d).select("STATION", "LATITUDE", "LONGITUDE").distinct()
    return _rounded(nearest.nearest_site(airports, stations, "AIRPORT_ID", "STATION", "LATITUDE", "LONGITUDE", sphere=True), 3, "distance")


def _unit(prefix: str) -> str:
    lat, lon = f"radians({prefix}LATITUDE)", f"radians({prefix}LONGITUDE)"
    return f"cos({lat}) * cos({lon}) AS x, cos({lat}) * sin({lon}) AS y, sin({lat}) AS z"


FLIGHTS = """raw AS (SELECT *, (l_orderkey * 37 + l_linenumber * 101 + l_partkey * 7) % 1440 AS dep,
   ((l_orderkey * 37 + l_linenumber * 101 + l_partkey * 7) % 1440 + 60 + l_suppkey % 120) % 1440 AS arr FROM lineitem WHERE l_tax <> 0),
 fl AS MATERIALIZED (SELECT year(l_shipdate) AS YEAR, month(l_shipdate) AS MONTH, dayofweek(l_shipdate) + 1 AS DAY_OF_WEEK,
   DATE '2024-01-01' + (datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 3)::INT AS FL_DATE, 'C' || l_linenumber AS OP_CARRIER, 'N' || l_suppkey AS TAIL_NUM,
   l_orderkey % 25 AS ORIGIN_AIRPORT_ID, l_partkey % 25 AS DEST_AIRPORT_ID, dep // 60 * 100 + dep % 60 AS DEP_TIME, arr // 60 * 100 + arr % 60 AS CRS_ARR_TIME,
   dep // 60 AS DEP_HOUR, CASE WHEN l_quantity + dep // 60 > 45 THEN 1.0 ELSE 0.0 END::DOUBLE AS DEP_DEL15,
   CASE WHEN l_linenumber <> 7 THEN l_quantity ELSE 0 END AS ARR_DELAY_NEW, CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END AS WEATHER_DELAY,
   CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END AS NAS_DELAY, CASE WHEN l_linenumber = 1 THEN l_quantity ELSE 0 END AS SECURITY_DELAY,
   CASE WHEN l_linenumber > 4 THEN l_quantity ELSE 0 END AS LATE_AIRCRAFT_DELAY, CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END AS CARRIER_DELAY FROM raw)"""
WEATHER = """ke AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
 we AS MATERIALIZED (SELECT 'S' || lpad(user_id::VARCHAR, 9, '0') AS STATION, (user_id % 500)::DOUBLE AS ELEVATION,
   (user_id * 7919) % 1801 / 10.0::DOUBLE - 90 AS LATITUDE, (user_id * 104729) % 3601 / 10.0::DOUBLE - 180 AS LONGITUDE,
   DATE '2024-01-01' + (day(ts) % 3)::INT AS DATE_PART, hour(ts) AS HOUR_PART,
   CASE WHEN k % 10 = 0 THEN 0 ELSE k * 3 END::DOUBLE AS WND_ANGLE, CASE WHEN k % 7 = 0 THEN 0 ELSE k END::DOUBLE AS WND_SPEED,
   (k * 100)::DOUBLE AS CIG_HEIGHT, (k * 160)::DOUBLE AS VIS_DIST, CASE WHEN k % 9 = 0 THEN 15 ELSE k END::DOUBLE AS TMP_F,
   CASE WHEN k % 11 = 0 THEN 15 ELSE -k END::DOUBLE AS DEW_1, CASE WHEN k % 5 = 0 THEN 10132 ELSE k + 10000 END::DOUBLE AS SLP_1 FROM ke)"""
STATIONS = """ap AS (SELECT s_nationkey AS AIRPORT_ID, avg((s_nationkey * 5281) % 1801 / 10.0::DOUBLE - 90 + s_suppkey % 8 / 8.0::DOUBLE) AS LATITUDE,
   avg((s_nationkey * 31337) % 3601 / 10.0::DOUBLE - 180 + s_suppkey % 4 / 4.0::DOUBLE) AS LONGITUDE FROM supplier GROUP BY 1),
 st AS (SELECT DISTINCT STATION, LATITUDE, LONGITUDE FROM we),
 ix AS MATERIALIZED (SELECT AIRPORT_ID, LATITUDE, LONGITUDE, STATION, distance FROM (SELECT ap.*, st.STATION,
   sqrt(pow(ap.LATITUDE - st.LATITUDE, 2) + pow(ap.LONGITUDE - st.LONGITUDE, 2)) AS distance,
   row_number() OVER (PARTITION BY AIRPORT_ID ORDER BY pow(ap.LATITUDE - st.LATITUDE, 2) + pow(ap.LONGITUDE - st.LONGITUDE, 2), STATION) AS r
   FROM ap CROSS JOIN st) WHERE r = 1)"""
INBOUND = """ib AS MATERIALIZED (SELECT o.* EXCLUDE (ARR_DELAY_NEW), i.ARR_DELAY_NEW AS INBOUND_ARR_DELAY_NEW, i.CRS_ARR_TIME AS INBOUND_CRS_ARR_TIME FROM fl o LEFT JOIN fl i
   ON i.DEST_AIRPORT_ID = o.ORIGIN_AIRPORT_ID AND i.TAIL_NUM = o.TAIL_NUM AND i.FL_DATE = o.FL_DATE
   AND o.DEP_TIME - 400 < i.CRS_ARR_TIME AND i.CRS_ARR_TIME < o.DEP_TIME - 200)"""
INDEX = """di AS (SELECT OP_CARRIER, ORIGIN_AIRPORT_ID, avg(LATE_AIRCRAFT_DELAY) AS MEAN_LATE_AIRCRAFT_DELAY, avg(CARRIER_DELAY) AS MEAN_CARRIER_DELAY,
   avg(SECURITY_DELAY) AS MEAN_SECURITY_DELAY FROM fl WHERE YEAR = 1999 GROUP BY 1, 2)"""


def with_weather_sql(source: str) -> str:
    """One join per step, each step stored, so that the order stays as written."""
    def reads(prefix: str) -> str:
        return ", ".join(f"w.{c} AS {prefix}_{c}" for c in flights.READINGS)

    return f"""WITH j0 AS MATERIALIZED (SELECT f.*, o.STATION AS ORG_WS_ID FROM {source} f JOIN ix o ON o.AIRPORT_ID = f.ORIGIN_AIRPORT_ID),
 j1 AS MATERIALIZED (SELECT f.*, d.STATION AS DEST_WS_ID FROM j0 f JOIN ix d ON d.AIRPORT_ID = f.DEST_AIRPORT_ID),
 j2 AS MATERIALIZED (SELECT f.*, {reads('ORG')} FROM j1 f LEFT JOIN we w ON w.STATION = f.ORG_WS_ID AND w.DATE_PART = f.FL_DATE AND w.HOUR_PART = f.DEP_HOUR)
 SELECT f.*, {reads('DEST')} FROM j2 f LEFT JOIN we w ON w.STATION = f.DEST_WS_ID AND w.DATE_PART = f.FL_DATE AND w.HOUR_PART = f.DEP_HOUR"""


def clean_flights(spark, d):
    return flights.clean_flights(derived.raw_flights(spark, d))


def clean_weather(spark, d):
    return flights.clean_weather(derived.raw_weather(spark, d))


_LEGS = ["TAIL_NUM", "FL_DATE", "ORIGIN_AIRPORT_ID", "DEP_TIME", "CRS_ARR_TIME", "INBOUND_CRS_ARR_TIME", "INBOUND_ARR_DELAY_NEW"]
_LEG_COLUMNS = ", ".join([*(f"o.{c}" for c in _LEGS[:5]), "i.CRS_ARR_TIME AS INBOUND_CRS_ARR_TIME", "i.ARR_DELAY_NEW AS INBOUND_ARR_DELAY_NEW"])


def _legs(spark, d, clock):
    return flights.attach_inbound(clean_flights(spark, d), clock).select(*_LEGS)


def flight_features(spark, d):
    """Version 3: inbound leg, delay index of one year, weather."""
    f = clean_flights(spark, d)
    return flights.flight_features(f, clean_weather(spark, d), derived.airport_rows(spark, d), index_flights=f.where("YEAR = 1999"))


FEATURES = ["YEAR", "TAIL_NUM", "CRS_ARR_TIME", flights.LABEL, *flights.BEST_SET]
KEY_FEATURES = [c for c in FEATURES if not c.startswith("MEAN_")]


def _features_out(df):
    return df.select(*KEY_FEATURES, *[F.round(c, 6).alias(c) for c in FEATURES if c.startswith("MEAN_")])


_V3_COLS = ", ".join([*KEY_FEATURES, *[f"round({c}, 6) AS {c}" for c in FEATURES if c.startswith("MEAN_")]])
WEATHER_OUT = ["STATION", "LATITUDE", "LONGITUDE", "DATE_PART", "HOUR_PART", *flights.READINGS]
COMPACT_OUT = ["TAIL_NUM", "DEP_TIME", "CRS_ARR_TIME", "INBOUND_ARR_DELAY_NEW", *flights.WEATHER_SET]
WEATHER_RAW = WEATHER.replace(" we AS MATERIALIZED (", " wr AS MATERIALIZED (")
V1_OUT = ["TAIL_NUM", "DEP_TIME", "CRS_ARR_TIME", "ORG_WS_ID", "DEST_WS_ID", *flights.WEATHER_SET]
DELAY_OUT = ["TAIL_NUM", "DEP_TIME", "CRS_ARR_TIME", "DEP_HOUR", "DAY_OF_WEEK", "MONTH", "YEAR", flights.LABEL, *flights.DELAYS]

def _named_priorities(spark, d):
    """Orders per priority, named by a table typed into the program."""
    names = literal(spark, [("1-URGENT", "now", 1), ("2-HIGH", "soon", 2), ("5-LOW", "some day", 5)], "o_orderpriority string, name string, level int")
    return table(spark, d, "orders").join(names, "o_orderpriority").groupBy("name", "level").agg(F.count("*").alias("orders"))


def _samples(spark, d):
    """Spark's own samplers, which no SQL can replay: are their rows rows of
    the table, none of them twice, and as many as the share says, within six
    standard deviations?"""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = _lines(spark, d).select(*keys).distinct()
    total = lines.count()
    train, test = sampling.random_split(lines, [0.8, 0.2])
    out = None
    for name, part, share in (("bernoulli", sampling.bernoulli(lines, 0.1), 0.1), ("split_train", train, 0.8), ("split_test", test, 0.2)):
        seen = part.groupBy(*keys).agg(F.count("*").alias("n")).join(lines.withColumn("known", F.lit(1)), keys, "left")
        near = F.abs(F.sum("n") - share * total) <= 6 * math.sqrt(total * share * (1 - share)) + 1
        row = seen.agg(F.lit(name).alias("sample"), F.count_if(F.col("known").isNull()).alias("unknown"), F.count_if(F.col("n") > 1).alias("twice"), near.cast("int").alias("near"))
        out = row if out is None else out.union(row)
    return out


def _previewed(spark, d):
    """A preview has its number of rows, all of them rows of the table."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    some = counting.preview(orders, 20)
    return some.join(orders.distinct(), ["o_orderkey", "o_custkey"], "left_semi").agg(F.count("*").alias("rows"))


QUERIES = {
    "distinct_per_column": (
        lambda s, d: profile.distinct_counts(table(s, d, "events")),
        _counts_sql("events", ["event_id", "ts", "user_id", "event_type", "value", "props"], "count(DISTINCT {c})", "distinct_values"),
    ),
    "null_profile": (
        lambda s, d: profile.null_counts(_gappy(s, d)),
        f"WITH {GAPPY} " + _counts_sql("gappy", ["doc_id", "lang", "source", "n_chars"], "count(*) FILTER ({c} IS NULL)", "nulls"),
    ),
    "blank_profile": (
        lambda s, d: _rounded(profile.blank_fractions(_gappy(s, d), ["lang", "source", "n_chars"]), 6, "blank_fraction"),
        f"WITH {GAPPY} "
        + _counts_sql("gappy", ["lang", "source", "n_chars"], "round(avg((coalesce(trim({c}::VARCHAR), '') = '')::INT), 6)", "blank_fraction"),
    ),
    "completeness_screen": (
        lambda s, d: _rounded(profile.complete_columns(_gappy(s, d), ["lang", "source", "n_chars"]), 6, "filled"),
        f"WITH {GAPPY}, f AS ("
        + _counts_sql("gappy", ["lang", "source", "n_chars"], "1 - avg((coalesce(trim({c}::VARCHAR), '') = '')::INT)", "filled")
        + ') SELECT "column", round(filled, 6) AS filled FROM f WHERE filled >= 0.8',
    ),
    "outcome_odds": (
        lambda s, d: _rounded(profile.outcome_odds(_lines(s, d), F.col("l_returnflag") == "R"), 6, "rate", "odds"),
        """SELECT count(*) FILTER (l_returnflag = 'R') AS with_outcome, count(*) FILTER (l_returnflag <> 'R') AS without_outcome,
 round(avg((l_returnflag = 'R')::INT), 6) AS rate, round(count(*) FILTER (l_returnflag = 'R') / count(*) FILTER (l_returnflag <> 'R'), 6) AS odds FROM lineitem""",
    ),
    "outcome_rate_by_dimensions": (
        lambda s, d: _rounded(profile.outcome_rates(_lines(s, d), F.col("l_returnflag") == "R", _dims()), 6, "rate"),
        RATES_SQL,
    ),
    "group_mean_index": (
        lambda s, d: _rounded(profile.group_means(_lines(s, d), MONEY_KEYS, MONEY), 6, *[f"MEAN_{c}" for c in MONEY]),
        f"SELECT l_suppkey, l_returnflag, {', '.join(f'round(avg({c}), 6) AS MEAN_{c}' for c in MONEY)} FROM lineitem GROUP BY 1, 2",
    ),
    "group_median_index": (
        lambda s, d: profile.group_medians(_lines(s, d), MONEY_KEYS, MONEY),
        f"SELECT l_suppkey, l_returnflag, {', '.join(f'quantile_disc({c}, 0.5) AS MEDIAN_{c}' for c in MONEY)} FROM lineitem GROUP BY 1, 2",
    ),
    "value_counts": (
        lambda s, d: profile.value_counts(table(s, d, "events"), "event_type").orderBy(F.desc("n"), "value"),
        "SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1",
    ),
    "histogram": (
        lambda s, d: _rounded(profile.histogram(_lines(s, d), "l_extendedprice", 50), 4, "low", "high"),
        """WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
 b AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 50)), 49) AS INT) + 1 AS bin, lo, (hi - lo) / 50 AS w FROM lineitem, e)
 SELECT bin, round(lo + (bin - 1) * w, 4) AS low, round(lo + bin * w, 4) AS high, count(*) AS n FROM b GROUP BY bin, lo, w""",
    ),
    "histogram_clipped": (
        lambda s, d: _rounded(profile.histogram(table(s, d, "events"), "value", 30, upper=100.0), 4, "low", "high"),
        """WITH v AS (SELECT value FROM events WHERE value <= 100), e AS (SELECT min(value) AS lo, max(value) AS hi FROM v),
 b AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / 30)), 29) AS INT) + 1 AS bin, lo, (hi - lo) / 30 AS w FROM v, e)
 SELECT bin, round(lo + (bin - 1) * w, 4) AS low, round(lo + bin * w, 4) AS high, count(*) AS n FROM b GROUP BY bin, lo, w""",
    ),
    "box_stats": (
        lambda s, d: profile.box_stats(_lines(s, d), "l_returnflag", "l_extendedprice"),
        """SELECT l_returnflag, min(l_extendedprice) AS low, quantile_disc(l_extendedprice, 0.25) AS q1, quantile_disc(l_extendedprice, 0.5) AS median,
 quantile_disc(l_extendedprice, 0.75) AS q3, max(l_extendedprice) AS high, count(*) AS n FROM lineitem GROUP BY 1""",
    ),
    "correlation_matrix": (
        lambda s, d: _rounded(profile.correlations(_lines(s, d), NUMBERS), 6, "r"),
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1 :]
        ),
    ),
    "summary_stats": (
        lambda s, d: _rounded(profile.describe(_lines(s, d), NUMBERS), 6, "mean", "stddev"),
        " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {STATS_SQL.format(c=c)} FROM lineitem" for c in NUMBERS),
    ),
    "row_count": (lambda s, d: profile.row_count(_lines(s, d)), "SELECT count(*) AS n FROM lineitem"),
    "distinct_rows": (
        lambda s, d: _lines(s, d).select("l_suppkey", "l_returnflag", "l_linestatus").distinct(),
        "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem",
    ),
    "sql_view": (
        lambda s, d: query(s, "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer_view", customer_view=table(s, d, "customer")),
        "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer",
    ),
    "composite_split": (
        lambda s, d: table(s, d, "orders").select(
            "o_orderkey",
            clean.composite_field("o_orderpriority", 0, "int", "-").alias("level"),
            clean.composite_field("o_orderpriority", 1, "string", "-").alias("name"),
        ),
        """SELECT o_orderkey, TRY_CAST(string_split(o_orderpriority, '-')[1] AS INT) AS level, string_split(o_orderpriority, '-')[2] AS name FROM orders""",
    ),
    "clock_hour": (
        lambda s, d: clean_flights(s, d).select(
            "TAIL_NUM", "DEP_TIME", "DEP_HOUR", clean.clock_hour("DEP_TIME", "half_even").alias("rounded"), clean.clock_minutes("DEP_TIME").alias("minute")
        ),
        f"""WITH {FLIGHTS} SELECT TAIL_NUM, DEP_TIME, DEP_HOUR, CASE WHEN DEP_TIME % 100 > 50 OR (DEP_TIME % 100 = 50 AND DEP_HOUR % 2 = 1)
 THEN DEP_HOUR + 1 ELSE DEP_HOUR END AS rounded, DEP_HOUR * 60 + DEP_TIME % 100 AS minute FROM fl""",
    ),
    "flights_cleaned": (
        lambda s, d: clean_flights(s, d).select(*DELAY_OUT),
        f"WITH {FLIGHTS} SELECT {', '.join(DELAY_OUT)} FROM fl",
    ),
    "weather_cleaned": (
        lambda s, d: clean_weather(s, d).select(*WEATHER_OUT).withColumn("DATE_PART", F.col("DATE_PART").cast("string")),
        f"WITH {WEATHER} SELECT {', '.join(WEATHER_OUT).replace('DATE_PART', 'CAST(DATE_PART AS VARCHAR) AS DATE_PART')} FROM we",
    ),
    "weather_until": (
        lambda s, d: flights.clean_weather(derived.raw_weather(s, d), until="2024-01-02").groupBy("STATION").agg(F.count("*").alias("reports")),
        """SELECT 'S' || lpad(user_id::VARCHAR, 9, '0') AS STATION, count(*) AS reports FROM events
 WHERE day(ts) % 3 = 0 OR (day(ts) % 3 = 1 AND hour(ts) = 0 AND minute(ts) = 0 AND second(ts) = 0) GROUP BY 1""",
    ),
    "airport_mean_position": (
        lambda s, d: _rounded(
            derived.airport_rows(s, d).groupBy("AIRPORT_ID").agg(F.avg("LATITUDE").alias("LATITUDE"), F.avg("LONGITUDE").alias("LONGITUDE")), 6, "LATITUDE", "LONGITUDE"
        ),
        f"WITH {WEATHER}, {STATIONS} SELECT AIRPORT_ID, round(LATITUDE, 6) AS LATITUDE, round(LONGITUDE, 6) AS LONGITUDE FROM ap",
    ),
    "nearest_station": (
        lambda s, d: _rounded(flights.station_index(clean_weather(s, d), derived.airport_rows(s, d)), 6, "LATITUDE", "LONGITUDE"),
        f"WITH {WEATHER}, {STATIONS} SELECT AIRPORT_ID, STATION, round(LATITUDE, 6) AS LATITUDE, round(LONGITUDE, 6) AS LONGITUDE FROM ix",
    ),
    "nearest_supplier": (
        _nearest_supplier,
        """SELECT c_custkey, s_suppkey, round(sqrt(d2), 6) AS distance FROM (SELECT c_custkey, s_suppkey, d2,
 row_number() OVER (PARTITION BY c_custkey ORDER BY d2, s_suppkey) AS r FROM (SELECT c_custkey, s_suppkey,
 pow(s_acctbal / 100 - c_acctbal / 100, 2) + pow(s_nationkey * 4.0 - c_nationkey * 4.0, 2)::DOUBLE AS d2 FROM customer CROSS JOIN supplier)) WHERE r = 1""",
    ),
    "nearest_station_sphere": (
        _nearest_on_sphere,
        f"""WITH {WEATHER}, {STATIONS}, au AS (SELECT AIRPORT_ID, {_unit('ap.')} FROM ap), su AS (SELECT STATION, {_unit('st.')} FROM st),
 pd AS (SELECT AIRPORT_ID, STATION, pow(au.x - su.x, 2) + pow(au.y - su.y, 2) + pow(au.z - su.z, 2) AS d2 FROM au CROSS JOIN su)
 SELECT AIRPORT_ID, STATION, round(2 * {nearest.EARTH_KM} * asin(least(sqrt(d2) / 2, 1)), 3) AS distance FROM
 (SELECT *, row_number() OVER (PARTITION BY AIRPORT_ID ORDER BY d2, STATION) AS r FROM pd) WHERE r = 1""",
    ),
    "dim_lookup_two_roles": (
        _two_roles,
        """SELECT l_orderkey, l_linenumber, l_partkey, b.n_name AS buyer_nation, n.n_name AS seller_nation FROM lineitem JOIN orders ON o_orderkey = l_orderkey
 JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation b ON b.n_nationkey = c_nationkey JOIN nation n ON n.n_nationkey = s_nationkey""",
    ),
    "hourly_left_lookup": (
        _hourly,
        f"""WITH {EVENT_TIMES} SELECT p.event_id, e.event_id AS error_id, e.value AS error_value FROM (SELECT * FROM ev WHERE event_type = 'purchase') p
 LEFT JOIN (SELECT * FROM ev WHERE event_type = 'error') e ON e.user_id = p.user_id AND e.day = p.day AND e.hour = p.hour""",
    ),
    "range_self_join": (
        _earlier,
        f"""WITH {EVENT_TIMES} SELECT a.event_id, b.event_id AS earlier_id FROM ev a LEFT JOIN ev b ON a.user_id = b.user_id AND a.day = b.day
 AND b.minute > a.minute - 240 AND b.minute < a.minute - 120""",
    ),
    "range_self_summary": (
        _earlier_summary,
        f"""WITH {EVENT_TIMES} SELECT a.event_id, count(b.event_id) AS matches, round(avg(b.value), 6) AS mean_value, max(b.value) AS max_value
 FROM ev a LEFT JOIN ev b ON a.user_id = b.user_id AND a.day = b.day AND b.minute > a.minute - 240 AND b.minute < a.minute - 120 GROUP BY 1""",
    ),
    "attach_group_index": (
        _indexed_lines,
        """SELECT l_orderkey, l_partkey, round(l_quantity - m, 6) AS above_mean FROM lineitem JOIN
 (SELECT l_suppkey, l_returnflag, avg(l_quantity) AS m FROM lineitem GROUP BY 1, 2) USING (l_suppkey, l_returnflag)""",
    ),
    "flight_inbound_minutes": (
        lambda s, d: _legs(s, d, "minutes"),
        f"""WITH {FLIGHTS}, mi AS (SELECT *, DEP_TIME // 100 * 60 + DEP_TIME % 100 AS dm, CRS_ARR_TIME // 100 * 60 + CRS_ARR_TIME % 100 AS am FROM fl)
 SELECT {_LEG_COLUMNS} FROM mi o LEFT JOIN mi i ON i.DEST_AIRPORT_ID = o.ORIGIN_AIRPORT_ID AND i.TAIL_NUM = o.TAIL_NUM AND i.FL_DATE = o.FL_DATE
 AND o.dm - 240 < i.am AND i.am < o.dm - 120""",
    ),
    "flight_inbound_dated": (
        lambda s, d: _legs(s, d, "dated"),
        f"""WITH {FLIGHTS}, mi AS (SELECT *, DEP_TIME // 100 * 60 + DEP_TIME % 100 AS dm, CRS_ARR_TIME // 100 * 60 + CRS_ARR_TIME % 100 AS am FROM fl),
 ab AS (SELECT *, FL_DATE::TIMESTAMP + dm * INTERVAL 1 MINUTE AS leaves, FL_DATE::TIMESTAMP + (am + CASE WHEN am < dm THEN 1440 ELSE 0 END) * INTERVAL 1 MINUTE AS lands FROM mi)
 SELECT {_LEG_COLUMNS} FROM ab o LEFT JOIN ab i ON i.DEST_AIRPORT_ID = o.ORIGIN_AIRPORT_ID AND i.TAIL_NUM = o.TAIL_NUM
 AND o.leaves - INTERVAL 240 MINUTE < i.lands AND i.lands < o.leaves - INTERVAL 120 MINUTE""",
    ),
    "flights_without_station": (
        lambda s, d: joins.unmatched_keys(clean_flights(s, d), derived.airport_rows(s, d).where("AIRPORT_ID % 4 <> 0"), "ORIGIN_AIRPORT_ID", "AIRPORT_ID"),
        f"""WITH {FLIGHTS} SELECT ORIGIN_AIRPORT_ID AS key, count(*) AS rows FROM fl
 WHERE ORIGIN_AIRPORT_ID NOT IN (SELECT s_nationkey FROM supplier WHERE s_nationkey % 4 <> 0) GROUP BY 1""",
    ),
    "flight_inbound_legs": (
        lambda s, d: flights.attach_inbound(clean_flights(s, d)).select(
            "TAIL_NUM", "ORIGIN_AIRPORT_ID", "DEP_TIME", "CRS_ARR_TIME", "INBOUND_CRS_ARR_TIME", "INBOUND_ARR_DELAY_NEW"
        ),
        f"WITH {FLIGHTS}, {INBOUND} SELECT TAIL_NUM, ORIGIN_AIRPORT_ID, DEP_TIME, CRS_ARR_TIME, INBOUND_CRS_ARR_TIME, INBOUND_ARR_DELAY_NEW FROM ib",
    ),
    "flight_weather": (
        lambda s, d: flights.flight_features(
            clean_flights(s, d), clean_weather(s, d), derived.airport_rows(s, d), inbound=False
        ).select(*V1_OUT),
        f"WITH {FLIGHTS}, {WEATHER}, {STATIONS} SELECT {', '.join(V1_OUT)} FROM ({with_weather_sql('fl')})",
    ),
    "flight_features": (
        lambda s, d: _features_out(flight_features(s, d)),
        f"""WITH {FLIGHTS}, {WEATHER}, {STATIONS}, {INBOUND}, {INDEX}, fx AS MATERIALIZED (SELECT * FROM ib JOIN di USING (OP_CARRIER, ORIGIN_AIRPORT_ID))
 SELECT {_V3_COLS} FROM ({with_weather_sql('fx')})""",
    ),
    "flight_features_inbound": (
        lambda s, d: flights.flight_features(clean_flights(s, d), clean_weather(s, d), derived.airport_rows(s, d)).select(*V1_OUT, "INBOUND_ARR_DELAY_NEW"),
        f"""WITH {FLIGHTS}, {WEATHER}, {STATIONS}, {INBOUND} SELECT {', '.join(V1_OUT)}, INBOUND_ARR_DELAY_NEW FROM ({with_weather_sql('ib')})""",
    ),
    "flight_features_median": (
        lambda s, d: flights.attach_delay_index(clean_flights(s, d), flights.delay_index(clean_flights(s, d), "median")).select(
            "TAIL_NUM", "DEP_TIME", "CRS_ARR_TIME", "MEDIAN_LATE_AIRCRAFT_DELAY", "MEDIAN_CARRIER_DELAY", "MEDIAN_SECURITY_DELAY"
        ),
        f"""WITH {FLIGHTS} SELECT TAIL_NUM, DEP_TIME, CRS_ARR_TIME, m.* EXCLUDE (OP_CARRIER, ORIGIN_AIRPORT_ID) FROM fl JOIN (SELECT OP_CARRIER, ORIGIN_AIRPORT_ID,
 quantile_disc(LATE_AIRCRAFT_DELAY, 0.5) AS MEDIAN_LATE_AIRCRAFT_DELAY, quantile_disc(CARRIER_DELAY, 0.5) AS MEDIAN_CARRIER_DELAY,
 quantile_disc(SECURITY_DELAY, 0.5) AS MEDIAN_SECURITY_DELAY FROM fl GROUP BY 1, 2) m USING (OP_CARRIER, ORIGIN_AIRPORT_ID)""",
    ),
    "flight_features_compact": (
        lambda s, d: _rounded(
            flights.flight_features(clean_flights(s, d), clean_weather(s, d), derived.airport_rows(s, d), compact=True).select(*COMPACT_OUT, "INBOUND_LEGS"),
            6, "INBOUND_ARR_DELAY_NEW", *flights.WEATHER_SET,
        ),
        f"""WITH {FLIGHTS}, {WEATHER_RAW}, we AS (SELECT STATION, LATITUDE, LONGITUDE, DATE_PART, HOUR_PART, {', '.join(f'avg({c}) AS {c}' for c in flights.READINGS)}
 FROM wr GROUP BY ALL), {STATIONS}, lg AS (SELECT row_number() OVER () AS rid, * FROM fl),
 ib AS (SELECT any_value(o.TAIL_NUM) AS TAIL_NUM, any_value(o.DEP_TIME) AS DEP_TIME, any_value(o.CRS_ARR_TIME) AS CRS_ARR_TIME, any_value(o.DEP_HOUR) AS DEP_HOUR,
   any_value(o.FL_DATE) AS FL_DATE, any_value(o.ORIGIN_AIRPORT_ID) AS ORIGIN_AIRPORT_ID, any_value(o.DEST_AIRPORT_ID) AS DEST_AIRPORT_ID,
   count(i.rid) AS INBOUND_LEGS, round(avg(i.ARR_DELAY_NEW), 6) AS INBOUND_ARR_DELAY_NEW FROM lg o LEFT JOIN lg i ON i.DEST_AIRPORT_ID = o.ORIGIN_AIRPORT_ID
   AND i.TAIL_NUM = o.TAIL_NUM AND i.FL_DATE = o.FL_DATE AND o.DEP_TIME - 400 < i.CRS_ARR_TIME AND i.CRS_ARR_TIME < o.DEP_TIME - 200 GROUP BY o.rid)
 SELECT TAIL_NUM, DEP_TIME, CRS_ARR_TIME, INBOUND_LEGS, INBOUND_ARR_DELAY_NEW, {', '.join(f'round({c}, 6) AS {c}' for c in flights.WEATHER_SET)} FROM ({with_weather_sql('ib')})""",
    ),
    "labelled_rows": (
        lambda s, d: flights.labelled(flight_features(s, d), flights.BEST_SET).agg(
            F.count("*").alias("kept"), F.round(F.avg(flights.LABEL), 6).alias("positive_rate")
        ),
        f"""WITH {FLIGHTS}, {WEATHER}, {STATIONS}, {INBOUND}, {INDEX}, fx AS MATERIALIZED (SELECT * FROM ib JOIN di USING (OP_CARRIER, ORIGIN_AIRPORT_ID))
 SELECT count(*) AS kept, round(avg(DEP_DEL15), 6) AS positive_rate FROM ({with_weather_sql('fx')}) WHERE {' AND '.join(c + ' IS NOT NULL' for c in flights.BEST_SET)}""",
    ),
    "hash_sample": (
        lambda s, d: sampling.hash_sample(_lines(s, d).select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber", "l_partkey"], 0.1),
        """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
 WHERE ('0x' || substr(md5('42|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey), 1, 8))::BIGINT / 4294967296.0 < 0.1""",
    ),
    "fixed_size_sample": (
        lambda s, d: sampling.fixed_size(table(s, d, "orders").select("o_orderkey"), ["o_orderkey"], 1000),
        "SELECT o_orderkey FROM orders ORDER BY ('0x' || substr(md5('42|' || o_orderkey), 1, 8))::BIGINT, o_orderkey LIMIT 1000",
    ),
    "hash_split": (
        lambda s, d: sampling.hash_split(table(s, d, "orders"), ["o_orderkey"]).select("o_orderkey", F.col("is_train").cast("int").alias("is_train")),
        "SELECT o_orderkey, (('0x' || substr(md5('42|' || o_orderkey), 1, 8))::BIGINT / 4294967296.0 < 0.8)::INT AS is_train FROM orders",
    ),
    "kfold_assign": (
        lambda s, d: sampling.assign_folds(table(s, d, "orders").select("o_orderkey"), ["o_orderkey"], 5),
        "SELECT o_orderkey, (('0x' || substr(md5('42|' || o_orderkey), 1, 8))::BIGINT % 5)::INT AS fold FROM orders",
    ),
    "positional_split": (
        lambda s, d: sampling.positional_split(table(s, d, "orders").select("o_orderkey"), "o_orderkey", fraction=0.8).select(
            "o_orderkey", F.col("is_train").cast("int").alias("is_train")
        ),
        "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) <= floor((SELECT count(*) FROM orders) * 0.8))::INT AS is_train FROM orders",
    ),
    "global_rank": (
        lambda s, d: skew.global_rank(table(s, d, "events").select("event_id"), "event_id"),
        "SELECT event_id, row_number() OVER (ORDER BY event_id) AS rank FROM events",
    ),
    "time_split": (
        lambda s, d: sampling.time_split(table(s, d, "orders"), F.year("o_orderdate"), 2000).select("o_orderkey", F.col("is_train").cast("int").alias("is_train")),
        "SELECT o_orderkey, (year(o_orderdate) < 2000)::INT AS is_train FROM orders",
    ),
    "preview": (lambda s, d: counting.preview(_lines(s, d)), None),
    "preview_rows": (_previewed, "SELECT least(20, count(*)) AS rows FROM orders"),
    "literal_lookup": (
        _named_priorities,
        """SELECT name, level, count(*) AS orders FROM orders JOIN (VALUES ('1-URGENT', 'now', 1), ('2-HIGH', 'soon', 2), ('5-LOW', 'some day', 5)) t(p, name, level)
 ON p = o_orderpriority GROUP BY 1, 2""",
    ),
    "sample_checks": (_samples, "SELECT unnest(['bernoulli', 'split_train', 'split_test']) AS sample, 0 AS unknown, 0 AS twice, 1 AS near"),
    "sample_bernoulli": (lambda s, d: sampling.bernoulli(_lines(s, d).select("l_orderkey", "l_linenumber"), 0.1), None),
    "sample_with_replacement": (
        lambda s, d: sampling.poisson_copies(_lines(s, d).select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber", "l_partkey"], 0.6),
        f"""SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, unnest(range({' + '.join(f'(u >= {b!r}::DOUBLE)::INT' for b in sampling.poisson_bounds(0.6))})) AS copy
 FROM (SELECT *, ('0x' || substr(md5('42|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM lineitem))""",
    ),
    "random_split": (
        lambda s, d: (lambda a, b: a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test"))))(
            *sampling.random_split(table(s, d, "orders").select("o_orderkey"), [0.8, 0.2])
        ),
        None,
    ),
}
