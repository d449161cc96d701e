"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.sources.readers import spread, table


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, text, quality)`` of the labelled documents."""
    docs = spread(table(spark, folder, "documents")).select("doc_id", "text")
    return docs.join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")


def trade_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Customers link to the suppliers of their order lines; suppliers with an
    even number link back from first lines, the others link nowhere."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customer, supplier = F.concat(F.lit("c"), F.col("o_custkey")), F.concat(F.lit("s"), F.col("l_suppkey"))
    out = F.struct(customer.alias("src"), supplier.alias("dst"))
    back = F.struct(supplier.alias("src"), customer.alias("dst"))
    returns = (F.col("l_linenumber") == 1) & (F.col("l_suppkey") % 2 == 0)
    return (
        lines.join(orders, "l_orderkey")
        .select(F.explode(F.when(returns, F.array(out, back)).otherwise(F.array(out))).alias("_e"))
        .groupBy("_e.src", "_e.dst")
        .agg(F.count("*").alias("weight"))
    )


def price_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Regression rows: three features, the price in thousands, a fold and the
    held-out mark."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        (F.col("l_extendedprice") / 1000).alias("price"),
        (F.col("l_orderkey") % 5).cast("int").alias("fold"),
        (F.col("l_orderkey") % 10 < 8).alias("is_train"),
    )


def raw_flights(spark: SparkSession, folder: str) -> DataFrame:
    """One flight per order line, in the raw flight schema. The supplier is
    the aircraft, order and part give the airports."""
    q = F.col("l_quantity")
    dep = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 101 + F.col("l_partkey") * 7) % 1440
    arr = (dep + 60 + F.col("l_suppkey") % 120) % 1440
    hhmm = lambda m: (F.floor(m / 60) * 100 + m % 60).cast("int")
    ship = F.to_date("l_shipdate")
    return spread(table(spark, folder, "lineitem")).select(
        F.year(ship).alias("YEAR"),
        F.month(ship).alias("MONTH"),
        F.dayofmonth(ship).alias("DAY_OF_MONTH"),
        F.dayofweek(ship).alias("DAY_OF_WEEK"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.datediff(ship, F.lit("1995-01-01").cast("date")) % 3).cast("int")).alias("FL_DATE"),
        F.concat(F.lit("C"), F.col("l_linenumber")).alias("OP_CARRIER"),
        F.concat(F.lit("N"), F.col("l_suppkey")).alias("TAIL_NUM"),
        F.concat(F.lit("A"), F.col("l_orderkey") % 25).alias("ORIGIN"),
        (F.col("l_orderkey") % 25).cast("int").alias("ORIGIN_AIRPORT_ID"),
        (F.col("l_partkey") % 25).cast("int").alias("DEST_AIRPORT_ID"),
        hhmm(dep).alias("DEP_TIME"),
        hhmm(arr).alias("CRS_ARR_TIME"),
        F.when(q + F.floor(dep / 60) > 45, 1.0).otherwise(0.0).alias("DEP_DEL15"),
        F.when(F.col("l_linenumber") != 7, q).alias("ARR_DELAY_NEW"),
        F.when(F.col("l_returnflag") == "R", q).alias("WEATHER_DELAY"),
        F.when(F.col("l_returnflag") == "A", q).alias("NAS_DELAY"),
        F.when(F.col("l_linenumber") == 1, q).alias("SECURITY_DELAY"),
        F.when(F.col("l_linenumber") > 4, q).alias("LATE_AIRCRAFT_DELAY"),
        F.when(F.col("l_linestatus") == "F", q).alias("CARRIER_DELAY"),
        F.when(F.col("l_tax") == 0, 1.0).otherwise(0.0).alias("CANCELLED"),
    )


def raw_weather(spark: SparkSession, folder: str) -> DataFrame:
    """One station report per event, in the raw weather schema: the user is
    the station, composite fields carry the event's ``k`` with missing codes."""
    k = F.get_json_object("props", "$.k").cast("int")
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    u = F.col("user_id")
    return spread(table(spark, folder, "events")).select(
        F.concat(F.lit("S"), pad(u, 9)).alias("STATION"),
        F.concat(
            F.date_add(F.lit("2024-01-01").cast("date"), F.dayofmonth("ts") % 3).cast("string"), F.lit("T"), F.date_format("ts", "HH:mm:ss")
        ).alias("DATE"),
        ((u * 7919) % 1801 / F.lit(10.0) - 90).alias("LATITUDE"),
        ((u * 104729) % 3601 / F.lit(10.0) - 180).alias("LONGITUDE"),
        (u % 500).cast("double").alias("ELEVATION"),
        F.concat(pad(F.when(k % 10 == 0, 999).otherwise(k * 3), 3), F.lit(",1,N,"), pad(F.when(k % 7 == 0, 9999).otherwise(k), 4), F.lit(",1")).alias("WND"),
        F.concat(pad(k * 100, 5), F.lit(",9,9,N")).alias("CIG"),
        F.concat(pad(k * 160, 6), F.lit(",1,N,1")).alias("VIS"),
        F.when(k % 9 == 0, "+9999,9").otherwise(F.concat(F.lit("+"), pad(k, 4), F.lit(",1"))).alias("TMP"),
        F.when(k % 11 == 0, "+9999,9").otherwise(F.concat(F.lit("-"), pad(k, 4), F.lit(",1"))).alias("DEW"),
        F.when(k % 5 == 0, "99999,9").otherwise(F.concat(pad(k + 10000, 5), F.lit(",1"))).alias("SLP"),
    )


def airport_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Coordinate rows, several per airport: one per supplier of a nation."""
    n, s = F.col("s_nationkey"), F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        n.alias("AIRPORT_ID"),
        F.concat(F.lit("Airport "), n).alias("DISPLAY_AIRPORT_NAME"),
        ((n * 5281) % 1801 / F.lit(10.0) - 90 + s % 8 / F.lit(8.0)).alias("LATITUDE"),
        ((n * 31337) % 3601 / F.lit(10.0) - 180 + s % 4 / F.lit(4.0)).alias("LONGITUDE"),
    )
