"""The flight-delay feature job: clean flights and weather, find each
airport's nearest station, attach weather, inbound leg and delay index."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.clean import clean_composites, clock_hour, clock_minutes, date_part, hour_part, nulls_to_zero, unique_columns
from millrace.operators.classify import complete_rows, fit, load_model, score
from millrace.operators.joins import attach_group_index, hourly_lookup, role_lookup, window_bucket, window_self_join, window_self_summary
from millrace.operators.nearest import nearest_site
from millrace.operators.profile import group_means, group_medians
from millrace.operators.sampling import time_split
from millrace.operators.skew import Heavy, heavy_keys
from millrace.session import stored
from millrace.sources.readers import parquet

# Column lists of the job.
DELAYS = ["WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY", "CARRIER_DELAY", "ARR_DELAY_NEW"]
FLIGHT_COLUMNS = [
    "DEP_DEL15", "WEATHER_DELAY", "NAS_DELAY", "CARRIER_DELAY", "OP_CARRIER", "SECURITY_DELAY", "ORIGIN",
    "ORIGIN_AIRPORT_ID", "LATE_AIRCRAFT_DELAY", "DEST_AIRPORT_ID", "DEP_TIME", "FL_DATE", "DEP_HOUR",
    "DAY_OF_WEEK", "DAY_OF_MONTH", "TAIL_NUM", "CRS_ARR_TIME", "ARR_DELAY_NEW", "MONTH", "YEAR",
]
READINGS = ["ELEVATION", "WND_ANGLE", "WND_SPEED", "CIG_HEIGHT", "VIS_DIST", "TMP_F", "DEW_1", "SLP_1"]
WEATHER_COLUMNS = ["STATION", *READINGS, "LATITUDE", "LONGITUDE", "DATE"]
INDEXED_DELAYS = ["LATE_AIRCRAFT_DELAY", "CARRIER_DELAY", "SECURITY_DELAY"]

# Fixed values: (target, source, field, missing code, default).
WEATHER_FIELDS = [
    ("WND_ANGLE", "WND", 0, 999, 0),
    ("WND_SPEED", "WND", 3, 9999, 0),
    ("CIG_HEIGHT", "CIG", 0, None, None),
    ("VIS_DIST", "VIS", 0, None, None),
    ("TMP_F", "TMP", 0, 9999, 15),
    ("DEW_1", "DEW", 0, 9999, 15),
    ("SLP_1", "SLP", 0, 99999, 10132),
]

# The feature sets of the experiments.
LABEL = "DEP_DEL15"
WEATHER_SET = [f"{role}_{c}" for role in ("ORG", "DEST") for c in READINGS]
WEATHER_SHORT_SET = [f"{role}_{c}" for role in ("ORG", "DEST") for c in ("WND_ANGLE", "WND_SPEED", "CIG_HEIGHT", "VIS_DIST", "TMP_F")]
SEASON_SET = [*WEATHER_SHORT_SET, "DAY_OF_WEEK", "DEP_TIME"]
INBOUND_SET = [*SEASON_SET, "INBOUND_ARR_DELAY_NEW"]
INDEX_SET = [*INBOUND_SET, *[f"MEAN_{c}" for c in INDEXED_DELAYS]]
BEST_SET = [*WEATHER_SET, "DAY_OF_WEEK", "DEP_TIME", "MONTH", "INBOUND_ARR_DELAY_NEW", *[f"MEAN_{c}" for c in INDEXED_DELAYS]]

# Columns that tell flights of one airport, carrier or aircraft apart.
SPREAD = ["TAIL_NUM", "FL_DATE", "DEP_TIME", "CRS_ARR_TIME"]


# Inbound legs arrive between these bounds before departure.
INBOUND_WINDOW = {"hhmm": (200, 400), "minutes": (120, 240), "dated": (120, 240)}

# Key columns of the joins of the job.
INDEX_KEYS = ["OP_CARRIER", "ORIGIN_AIRPORT_ID"]
FLIGHT_KEYS = {
    "INBOUND": ["ORIGIN_AIRPORT_ID", "TAIL_NUM", "FL_DATE", "_bucket"],
    "LANDED": ["DEST_AIRPORT_ID", "TAIL_NUM", "FL_DATE", "_first"],
    "LANDED_LATER": ["DEST_AIRPORT_ID", "TAIL_NUM", "FL_DATE", "_last"],
    "MOMENT": ["ORIGIN_AIRPORT_ID", "TAIL_NUM", "FL_DATE", "_at"],
    "ORIGIN_HOUR": ["ORIGIN_AIRPORT_ID", "FL_DATE", "DEP_HOUR"],
    "DEST_HOUR": ["DEST_AIRPORT_ID", "FL_DATE", "DEP_HOUR"],
}


def clean_flights(raw: DataFrame, hour_mode: str = "clock") -> DataFrame:
    """Flown flights with departure hour, chosen columns, delays without nulls."""
    kept = (
        raw.where(F.col("CANCELLED") == 0)
        .withColumn("DEP_HOUR", clock_hour("DEP_TIME", hour_mode))
        .select(*unique_columns(FLIGHT_COLUMNS))
    )
    return nulls_to_zero(kept, DELAYS)


def load_flights(spark: SparkSession, paths: str | Iterable[str], hour_mode: str = "clock") -> DataFrame:
    return clean_flights(parquet(spark, paths), hour_mode)


def clean_weather(raw: DataFrame, until: str | None = None) -> DataFrame:
    """Readings as numbers, missing codes replaced, date and hour split off.
    ``until`` keeps reports up to that moment."""
    typed = raw.withColumn("DATE", F.col("DATE").try_cast("timestamp_ntz"))
    if until is not None:
        typed = typed.where(F.col("DATE") <= F.lit(until).cast("timestamp_ntz"))
    return (
        clean_composites(typed, WEATHER_FIELDS)
        .select(*WEATHER_COLUMNS)
        .withColumn("DATE_PART", date_part("DATE"))
        .withColumn("HOUR_PART", hour_part("DATE"))
    )


def load_weather(spark: SparkSession, paths: str | Iterable[str], until: str | None = None) -> DataFrame:
    return clean_weather(parquet(spark, paths), until)


def station_index(weather: DataFrame, coordinates: DataFrame) -> DataFrame:
    """``(AIRPORT_ID, LATITUDE, LONGITUDE, STATION)``: mean position of each
    airport and its nearest station."""
    stations = weather.select("STATION", "LATITUDE", "LONGITUDE").distinct().na.drop()
    airports = (
        coordinates.groupBy("AIRPORT_ID")
        .agg(F.avg("LATITUDE").alias("LATITUDE"), F.avg("LONGITUDE").alias("LONGITUDE"))
        .na.drop()
    )
    nearest = nearest_site(airports, stations, "AIRPORT_ID", "STATION", "LATITUDE", "LONGITUDE")
    return airports.join(nearest.select("AIRPORT_ID", "STATION"), "AIRPORT_ID")


def heavy_flight_keys(flights: DataFrame, clock: str = "hhmm") -> dict[str, Heavy]:
    """The heavy keys of the large joins of the feature job, from one pass over
    a sample of the plain flights. Rows that a later join multiplies are left
    to the adaptive skew join."""
    lower, upper = INBOUND_WINDOW[clock]
    at = departure(clock)
    first, last = (window_bucket(arrival(clock) + edge, lower, upper) for edge in (lower, upper))
    timed = flights.withColumns({"_at": at, "_bucket": window_bucket(at, lower, upper), "_first": first, "_last": last})
    keys = {n: [c for c in k if c != "FL_DATE" or clock != "dated" or n.endswith("HOUR")] for n, k in FLIGHT_KEYS.items()}
    found = dict(zip(keys, heavy_keys(timed, *keys.values())))
    # a bucket holds arrivals for which it is the first or the last
    later = found.pop("LANDED_LATER")
    return found | {"LANDED": {k: found["LANDED"].get(k, 0) + later.get(k, 0) for k in found["LANDED"] | later}}


def attach_weather(
    flights: DataFrame,
    weather: DataFrame,
    index: DataFrame,
    heavy: dict[str, Heavy] | None = None,
    offset_hours: int = 0,
    hourly_means: bool = False,
) -> DataFrame:
    """Station and position of both airports, then the weather of both at the
    departure hour (``offset_hours`` earlier if set). Several reports of an
    hour give several rows; with ``hourly_means`` their mean gives one.

    Readings are first cut to the stations an airport uses and keyed by
    airport; that keeps most reports out of the two large joins.
    """
    heavy = heavy_flight_keys(flights) if heavy is None else heavy
    out = flights
    for role, station in (("ORIGIN", "ORG_WS_ID"), ("DEST", "DEST_WS_ID")):
        names = {"LATITUDE": f"{role}_LAT", "LONGITUDE": f"{role}_LON", "STATION": station}
        out = role_lookup(out, index, f"{role}_AIRPORT_ID", "AIRPORT_ID", names)
    used = weather.join(index.select("AIRPORT_ID", "STATION"), "STATION").withColumn(
        "_at", F.expr(f"timestampadd(HOUR, {offset_hours}, timestampadd(HOUR, HOUR_PART, CAST(DATE_PART AS TIMESTAMP_NTZ)))")
    ).withColumn("_date", F.to_date("_at")).withColumn("_hour", F.hour("_at"))
    if hourly_means:
        used = used.groupBy("AIRPORT_ID", "_date", "_hour").agg(*[F.avg(c).alias(c) for c in READINGS])
    for role, prefix in (("ORIGIN", "ORG_"), ("DEST", "DEST_")):
        keys = dict(zip(FLIGHT_KEYS[f"{role}_HOUR"], ("AIRPORT_ID", "_date", "_hour")))
        names = {c: prefix + c for c in READINGS}
        out = hourly_lookup(out, used, keys, names, SPREAD, heavy[f"{role}_HOUR"])
    return out


def _days() -> Column:
    return F.datediff(F.to_date("FL_DATE"), F.lit("1970-01-01").cast("date")) * 1440


def departure(clock: str) -> Column:
    if clock == "hhmm":
        return F.col("DEP_TIME").cast("int")
    return clock_minutes("DEP_TIME") + (_days() if clock == "dated" else F.lit(0))


def arrival(clock: str) -> Column:
    """With ``dated``, an arrival before its own departure is on the next day."""
    if clock == "hhmm":
        return F.col("CRS_ARR_TIME").cast("int")
    landed = clock_minutes("CRS_ARR_TIME")
    if clock == "minutes":
        return landed
    return _days() + landed + F.when(landed < clock_minutes("DEP_TIME"), 1440).otherwise(0)


def attach_inbound(flights: DataFrame, clock: str = "hhmm", compact: bool = False, heavy: dict[str, Heavy] | None = None) -> DataFrame:
    """Arrival delay of the same aircraft's inbound leg: same day, arriving at
    the airport of departure between two and four hours before it.

    ``hhmm`` compares the clock numbers, 200 and 400 apart; ``minutes``
    compares minutes of the day; ``dated`` compares minutes across midnight,
    so the leg may be of the day before. Each inbound leg gives a row. ``compact``
    gives one row per flight instead: the number of legs (``INBOUND_LEGS``)
    and their mean delay.
    """
    heavy = heavy_flight_keys(flights, clock) if heavy is None else heavy
    outbound = flights.drop("ARR_DELAY_NEW").withColumn("_at", departure(clock))
    inbound = flights.select(
        F.col("DEST_AIRPORT_ID").alias("ORIGIN_AIRPORT_ID"),
        "TAIL_NUM",
        "FL_DATE",
        arrival(clock).alias("_arrival"),
        F.col("CRS_ARR_TIME").alias("INBOUND_CRS_ARR_TIME"),
        F.col("ARR_DELAY_NEW").alias("INBOUND_ARR_DELAY_NEW"),
    )
    lower, upper = INBOUND_WINDOW[clock]
    keys = FLIGHT_KEYS["INBOUND"][: 2 if clock == "dated" else 3]
    if clock == "dated":
        inbound = inbound.drop("FL_DATE")
    spread = ["DEP_TIME", "CRS_ARR_TIME", "DEST_AIRPORT_ID", "OP_CARRIER"]
    if not compact:
        return window_self_join(outbound, inbound, keys, "_at", "_arrival", lower, upper, spread, heavy["INBOUND"], heavy["LANDED"]).drop("_at", "_arrival")
    delay = "INBOUND_ARR_DELAY_NEW"
    found = window_self_summary(outbound, inbound, keys, "_at", "_arrival", lower, upper, delay, spread, heavy["MOMENT"])
    return found.withColumnsRenamed({"matches": "INBOUND_LEGS", f"mean_{delay}": delay}).drop("_at", f"max_{delay}")


def delay_index(flights: DataFrame, statistic: str = "mean") -> DataFrame:
    """Delay statistics per (carrier, airport of departure)."""
    keys = INDEX_KEYS
    if statistic == "mean":
        return group_means(flights, keys, INDEXED_DELAYS)
    return group_medians(flights, keys, INDEXED_DELAYS)


def attach_delay_index(flights: DataFrame, index: DataFrame) -> DataFrame:
    return attach_group_index(flights, index, INDEX_KEYS)


def flight_features(
    flights: DataFrame,
    weather: DataFrame,
    coordinates: DataFrame,
    index_flights: DataFrame | None = None,
    inbound: bool = True,
    statistic: str = "mean",
    offset_hours: int = 0,
    compact: bool = False,
    clock: str = "hhmm",
) -> DataFrame:
    """All features of clean flights. Version 1 is ``inbound=False`` without
    ``index_flights``; version 2 adds the inbound leg; version 3 adds the
    delay index computed from ``index_flights`` (one year of the flights).

    Every matching leg and report gives a row. ``compact`` keeps one row per
    flight, with means over its legs and over the reports of an hour, however
    many rows an aircraft, a day or a station-hour holds."""
    heavy = heavy_flight_keys(flights, clock)
    out = flights
    if inbound:
        out = attach_inbound(out, clock, compact, heavy)
    if index_flights is not None:
        out = attach_delay_index(out, delay_index(index_flights, statistic))
    return attach_weather(out, weather, station_index(weather, coordinates), heavy, offset_hours, hourly_means=compact)


def labelled(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (), label: str = LABEL) -> DataFrame:
    """Label and features of complete rows, as doubles."""
    return complete_rows(df, label, features, keep)


def train_best(features: DataFrame, test_from: int, max_iter: int = 30):
    """Gradient-boosted trees on the 23 features; years before ``test_from``
    train. Returns the model and the test rows."""
    rows = stored(labelled(time_split(features, F.col("YEAR"), test_from), BEST_SET, ["is_train"]))
    model = fit(rows.where("is_train"), LABEL, BEST_SET, "gbt", max_iter=max_iter)
    return model, rows.where("NOT is_train").drop("is_train")


def score_flights(
    spark: SparkSession,
    model: PipelineModel | str,
    flight_paths,
    weather_paths,
    coordinates: DataFrame | None,
    index: DataFrame,
    known_stations: DataFrame | None = None,
    features: Sequence[str] = BEST_SET,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Batch scoring of new files with a saved model and a saved delay index;
    the station index is made from ``coordinates`` unless one is known."""
    flights = load_flights(spark, flight_paths)
    weather = load_weather(spark, weather_paths)
    heavy = heavy_flight_keys(flights)
    rows = attach_delay_index(attach_inbound(flights, heavy=heavy), index)
    stations = station_index(weather, coordinates) if known_stations is None else known_stations
    ready = attach_weather(rows, weather, stations, heavy)
    return score(load_model(model) if isinstance(model, str) else model, labelled(ready, features, keep))
