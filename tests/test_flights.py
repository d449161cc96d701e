from datetime import date

import pytest
from pyspark.sql import functions as F

from results import rows
from millrace.operators import classify
from millrace.plans import derived, flights
from millrace.sources import readers, writers

FLIGHT = (
    "YEAR int, MONTH int, DAY_OF_MONTH int, DAY_OF_WEEK int, FL_DATE date, OP_CARRIER string, TAIL_NUM string, ORIGIN string, "
    "ORIGIN_AIRPORT_ID int, DEST_AIRPORT_ID int, DEP_TIME int, CRS_ARR_TIME int, DEP_DEL15 double, ARR_DELAY_NEW double, WEATHER_DELAY double, "
    "NAS_DELAY double, SECURITY_DELAY double, LATE_AIRCRAFT_DELAY double, CARRIER_DELAY double, CANCELLED double"
)
WEATHER = "STATION string, DATE string, LATITUDE double, LONGITUDE double, ELEVATION double, WND string, CIG string, VIS string, TMP string, DEW string, SLP string"


def flight(tail="N1", origin=1, dest=2, dep=1300, arr=1500, delay=None, cancelled=0.0, year=2018, carrier="AA", late=None):
    return (year, 5, 1, 3, date(2018, 5, 1), carrier, tail, f"A{origin}", origin, dest, dep, arr, 1.0, delay, None, 2.0, None, late, None, cancelled)


def report(station, hour, wnd="160,1,N,0046,1", tmp="+0120,1", dew="+0050,1", slp="10100,1", lat=0.0, lon=0.0):
    return (station, f"2018-05-01T{hour:02d}:51:00", lat, lon, 10.0, wnd, "22000,5,9,N", "016093,5,N,5", tmp, dew, slp)


def test_clean_flights(spark):
    raw = spark.createDataFrame([flight(), flight(cancelled=1.0)], FLIGHT)
    out = flights.clean_flights(raw).collect()
    assert len(out) == 1 and out[0].DEP_HOUR == 13 and out[0].ARR_DELAY_NEW == 0 and out[0].NAS_DELAY == 2
    assert set(out[0].asDict()) == set(flights.FLIGHT_COLUMNS)


def test_clean_weather(spark):
    raw = spark.createDataFrame([report("S", 13), report("S", 14, "999,9,C,9999,9", "+9999,9", "+9999,9", "99999,9"), report("S", 15, "160")], WEATHER)
    got = {r.HOUR_PART: r for r in flights.clean_weather(raw).collect()}
    assert (got[13].WND_ANGLE, got[13].WND_SPEED, got[13].TMP_F, got[13].CIG_HEIGHT, got[13].VIS_DIST) == (160, 46, 120, 22000, 16093)
    assert (got[14].WND_ANGLE, got[14].WND_SPEED, got[14].TMP_F, got[14].DEW_1, got[14].SLP_1) == (0, 0, 15, 15, 10132)
    assert got[15].WND_SPEED is None and got[15].DATE_PART == date(2018, 5, 1)
    assert flights.clean_weather(raw, until="2018-05-01 14:00:00").count() == 1


def test_inbound_window_and_fan_out(spark):
    base = [flight(dep=1300, origin=1, tail="N9", dest=5)]
    inbound = [flight(tail="N9", origin=7, dest=1, dep=600, arr=a, delay=float(a)) for a in (900, 901, 1099, 1100)]
    out = flights.attach_inbound(flights.clean_flights(spark.createDataFrame(base + inbound, FLIGHT)))
    got = {r.INBOUND_ARR_DELAY_NEW for r in out.where("DEST_AIRPORT_ID = 5").collect()}
    assert got == {901.0, 1099.0}
    assert out.where("DEST_AIRPORT_ID = 1").count() == 4 and out.where("DEST_AIRPORT_ID = 1 AND INBOUND_ARR_DELAY_NEW IS NOT NULL").count() == 0
    by_minutes = flights.attach_inbound(flights.clean_flights(spark.createDataFrame(base + inbound, FLIGHT)), clock="minutes")
    assert {r.INBOUND_ARR_DELAY_NEW for r in by_minutes.where("DEST_AIRPORT_ID = 5").collect()} == {901.0}


def coordinates(spark):
    rows_ = [(1, "a", 0.0, 0.0), (1, "a", 0.2, 0.0), (2, "b", 10.0, 10.0), (3, "c", None, 1.0)]
    return spark.createDataFrame(rows_, readers.AIRPORT_COORDINATES)


def test_station_index_and_weather(spark):
    weather = flights.clean_weather(spark.createDataFrame(
        [report("S0", 13), report("S0", 13, "170,1,N,0050,1"), report("S9", 13, lat=9.0, lon=9.0), report("S5", 13, lat=-50.0), report("SX", 2, lat=None)], WEATHER
    ))
    index = flights.station_index(weather, coordinates(spark))
    assert {(r.AIRPORT_ID, r.STATION) for r in index.collect()} == {(1, "S0"), (2, "S9")}
    base = flights.clean_flights(spark.createDataFrame([flight(), flight(dep=200), flight(origin=3), flight(dest=77)], FLIGHT))
    out = flights.attach_weather(base, weather, index)
    assert rows(out.select("DEP_TIME", "ORG_WND_SPEED", "DEST_WND_SPEED")) == {(1300, 46, 46), (1300, 50, 46), (200, None, None)}
    later = flights.attach_weather(base, weather, index, offset_hours=2)
    assert later.where("ORG_WND_SPEED IS NOT NULL").count() == 0


def test_delay_index(spark):
    base = flights.clean_flights(spark.createDataFrame([flight(late=4.0), flight(late=8.0), flight(late=9.0), flight(carrier="BB", year=2017)], FLIGHT))
    mean = flights.delay_index(base.where("YEAR = 2018"))
    assert rows(mean.select("OP_CARRIER", "MEAN_LATE_AIRCRAFT_DELAY")) == {("AA", 7.0)}
    assert rows(flights.delay_index(base, "median").select("OP_CARRIER", "MEDIAN_LATE_AIRCRAFT_DELAY")) == {("AA", 8.0), ("BB", 0.0)}
    assert flights.attach_delay_index(base, mean).count() == 3


def test_feature_sets():
    assert len(flights.BEST_SET) == 23 and len(flights.WEATHER_SET) == 16 and len(flights.WEATHER_SHORT_SET) == 10


def test_train_save_and_score_files(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    raw_f, raw_w = derived.raw_flights(spark, folder), derived.raw_weather(spark, folder)
    raw_f.write.parquet(str(tmp_path / "flights"))
    raw_w.write.parquet(str(tmp_path / "weather"))
    f, w = flights.load_flights(spark, str(tmp_path / "flights")), flights.load_weather(spark, str(tmp_path / "weather"))
    coords = derived.airport_rows(spark, folder)
    index = flights.delay_index(f)
    features = flights.flight_features(f, w, coords, index_flights=f)
    model, test = flights.train_best(features, 2000, max_iter=2)
    assert set(test.columns) == {flights.LABEL, *flights.BEST_SET}
    classify.save_model(model, str(tmp_path / "model"))
    scored = flights.score_flights(spark, str(tmp_path / "model"), str(tmp_path / "flights"), str(tmp_path / "weather"), coords, index)
    assert scored.count() == flights.labelled(features, flights.BEST_SET).count()
    assert scored.where("prediction NOT IN (0.0, 1.0)").count() == 0


def test_readers(spark, tmp_path):
    (tmp_path / "mail.txt").write_text('d1\t1\t"Hi\tthere "you"\nd2\t0\tNA\tBody\n')
    assert rows(readers.mail(spark, str(tmp_path / "mail.txt"))) == {("d1", 1, '"Hi', 'there "you"'), ("d2", 0, "NA", "Body")}
    (tmp_path / "grams.txt").write_text("a b c\t3\t2\t1\n")
    assert rows(readers.ngram_file(spark, str(tmp_path / "grams.txt"))) == {("a b c", 3, 2, 1)}
    head = '"fixed acidity";"volatile acidity";"citric acid";"residual sugar";"chlorides";"free sulfur dioxide";"total sulfur dioxide";"density";"pH";"sulphates";"alcohol";"quality"\n'
    (tmp_path / "red.csv").write_text(head + "7.4;0.7;0;1.9;0.076;11;34;0.9978;3.51;0.56;9.4;5\n")
    (tmp_path / "white.csv").write_text(head + "7;0.27;0.36;20.7;0.045;45;170;1.001;3;0.45;8.8;6\n" * 2)
    wine = readers.wine(spark, str(tmp_path / "red.csv"), str(tmp_path / "white.csv"))
    assert wine.columns[0] == "color" and wine.columns[-1] == "quality" and len(wine.columns) == 13
    assert {(r.color, r.quality, r["count"]) for r in wine.groupBy("color", "quality").count().collect()} == {(1, 5.0, 1), (0, 6.0, 2)}
    (tmp_path / "links.txt").write_text("1\t{'2': 3, '4': 1}\n2\t{'1': 1}\n")
    assert rows(readers.adjacency_edges(spark, str(tmp_path / "links.txt"))) == {("1", "2", 3), ("1", "4", 1), ("2", "1", 1)}
    (tmp_path / "titles.txt").write_text("Page\t1\t3\t4\n")
    assert rows(readers.titles(spark, str(tmp_path / "titles.txt"))) == {("Page", "1", 3, 4)}
    (tmp_path / "coord.csv").write_text('SEQ,AIRPORT_ID,DISPLAY_AIRPORT_NAME,LATITUDE,LONGITUDE,X\n1,10,"A, B",1.5,-2.5,\n2,11,C,,3.0,z\n')
    assert rows(readers.airport_coordinates(spark, str(tmp_path / "coord.csv"))) == {(10, "A, B", 1.5, -2.5), (11, "C", None, 3.0)}
    assert readers.text_lines(spark, [str(tmp_path / "titles.txt"), str(tmp_path / "links.txt")]).count() == 3
    lit = readers.literal(spark, [(1, "a")], "n int, s string")
    assert rows(readers.query(spark, "SELECT s FROM t WHERE n = 1", t=lit)) == {("a",)}


def test_writers_round_trip(spark, tmp_path):
    model = spark.createDataFrame([("beijing", 0, 1, 0.125, 0.25), ("tokyo", 1, 0, 0.5, 0.0)], "word string, c0 long, c1 long, p0 double, p1 double")
    writers.write_model_lines(model, str(tmp_path / "model"))
    assert rows(readers.saved_model(spark, str(tmp_path / "model"))) == rows(model)
    writers.write_tsv(model.select("word", "c0"), str(tmp_path / "tsv"))
    assert rows(readers.tsv(spark, str(tmp_path / "tsv"), "word string, c0 long")) == rows(model.select("word", "c0"))
    writers.write_parquet(model, str(tmp_path / "pq"), ["c0"])
    assert readers.parquet(spark, str(tmp_path / "pq")).where("c0 = 1").count() == 1
    writers.write_parquet(model, str(tmp_path / "pq2"))
    assert readers.parquet(spark, str(tmp_path / "pq2" / "part-*.parquet")).count() == 2
    assert readers.parquet(spark, [str(tmp_path / "pq2"), str(tmp_path / "pq2")]).count() == 4


def test_spread_scan(spark, tmp_path):
    small = readers.table(spark, "/root/testdata/sf0.001", "documents")
    assert readers.spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    spark.range(100).repartition(60).write.parquet(str(tmp_path / "many"))
    many = readers.parquet(spark, str(tmp_path / "many"))
    assert readers.spread(many) is many


def test_streamed_word_counts(spark, tmp_path):
    from millrace import streaming

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one two\nTwo three\n")
    (tmp_path / "in" / "b.txt").write_text("three three\n")
    query = streaming.write_counts(streaming.running_word_counts(streaming.text_stream(spark, str(tmp_path / "in"), 1)), str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination(120)
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "out").iterdir())
    assert rows(spark.read.parquet(str(tmp_path / "out" / f"batch={last}"))) == {("one", 1), ("two", 2), ("three", 3)}
    query.stop()
