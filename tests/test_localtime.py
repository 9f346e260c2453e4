import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roost import localize_stops
from roost.functions.geo import with_wkt_edges
from roost.schemas import CLUSTERED, LOCAL, TZ_CODES

SQUARE = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"
TWO = "MULTIPOLYGON (((20 0, 22 0, 22 2, 20 2, 20 0)), ((30 0, 32 0, 32 2, 30 2, 30 0)))"


def stops_at(spark, *places, start=0.0, end=600.0):
    data = [
        ("a", i, float(start), float(end), float(end - start), float(lat), float(lon), -1, 1, float(lat), float(lon))
        for i, (lon, lat) in enumerate(places)
    ]
    return spark.createDataFrame(data, CLUSTERED)


def zones(spark, *polygons):
    return spark.createDataFrame(list(polygons), TZ_CODES)


def test_holes_parts_and_strangers(spark):
    tz = zones(spark, ("CO", "America/Bogota", SQUARE), ("CO", "America/Lima", TWO), ("MX", "America/Cancun", SQUARE))
    places = [(1, 1), (5, 5), (21, 1), (25, 1), (31, 1), (50, 50)]
    df = localize_stops(stops_at(spark, *places), tz, "CO", "America/Caracas")
    assert [z for _, z in rows(df, "stop_event", "timezone")] == [
        "America/Bogota", None, "America/Lima", None, "America/Lima", None,
    ]
    assert rows(df, "stop_event", "inputed_timezone")[1][1] == "America/Caracas"
    assert {f.name: f.dataType for f in df.schema} == {f.name: f.dataType for f in LOCAL}


@pytest.mark.parametrize(
    "text",
    [
        None, "", "POINT (1 1)", "POLYGON", "POLYGON EMPTY", "POLYGON ((0 0, 1 0, 1 1, 0 0)",
        "POLYGON ((0 0, 1 0, 1 1))", "POLYGON ((0 0, 1 0, 0 0))", "POLYGON ((0 0, 1 x, 1 1, 0 0))",
        "POLYGON ((0 0 5, 1 0 5, 1 1 5, 0 0 5))", "POLYGON (0 0, 1 0, 1 1, 0 0)", "POLYGON ((0 0, 1 0, 1 1, 0 0)) x",
        "MULTIPOLYGON ((0 0, 1 0, 1 1, 0 0))", "POLYGON ((0 0, 1 0, , 1 1, 0 0))",
    ],
)
def test_malformed_geometry_contains_nothing(spark, text):
    df = with_wkt_edges(zones(spark, ("CO", "UTC", text)), "geometry")
    assert rows(df, "edges") == [(None,)]


def test_wkt_spelling_is_free(spark):
    texts = ["polygon((0 0,1 0,1 1,0 0))", " POLYGON  ( ( 0  0 , 1 0 ,1 1, 0 0 ) ) ", "POLYGON ((0 0, 1e0 0, 1.0 1, 0 -0))"]
    df = with_wkt_edges(zones(spark, *[("CO", "UTC", t) for t in texts]), "geometry")
    assert rows(df.select(F.size("edges").alias("n")), "n") == [(3,)] * 3


def test_long_outline(spark):
    n = 60_000
    points = [f"{i / n} 0" for i in range(n)] + ["1 1", "0 1", "0 0"]
    tz = zones(spark, ("CO", "America/Lima", "POLYGON ((" + ", ".join(points) + "))"))
    df = localize_stops(stops_at(spark, (0.5, 0.5), (1.5, 0.5)), tz, "CO", "UTC")
    assert rows(df, "stop_event", "timezone") == [(0, "America/Lima"), (1, None)]


def test_overlap_repeats_the_stop(spark):
    tz = zones(spark, ("CO", "America/Lima", SQUARE), ("CO", "America/Bogota", SQUARE))
    stop = stops_at(spark, (1, 1))
    assert localize_stops(stop, tz, "CO", "UTC").count() == 2
    one = localize_stops(stop, tz, "CO", "UTC", one_tz="min")
    assert rows(one, "timezone") == [("America/Bogota",)]


def test_copies_of_bands_equal_broadcast(spark):
    tz = zones(spark, ("CO", "America/Lima", SQUARE), ("CO", "America/Bogota", TWO))
    stops = stops_at(spark, *[(x / 2, x % 11) for x in range(70)])
    columns = LOCAL.fieldNames()
    wide = localize_stops(stops, tz, "CO", "UTC")
    assert rows(wide, *columns) == rows(localize_stops(stops, tz, "CO", "UTC", max_broadcast_edges=0), *columns)
    assert "BroadcastHashJoin" in wide._jdf.queryExecution().executedPlan().toString()


def test_half_seconds_round_away_from_zero(spark):
    df = localize_stops(stops_at(spark, (50, 50), start=1.5, end=4.0), zones(spark).where("false"), "CO", "UTC")
    assert rows(df, "start_timestamp", "end_timestamp", "stop_duration") == [(2, 4, 3)]


def seconds(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc).timestamp()


@pytest.mark.parametrize(
    "utc, zone, local, weekday, weekend",
    [
        ("2024-01-01T04:30:00", "America/Bogota", "2023-12-31 23:30:00", 1, True),
        ("2024-01-06T05:30:00", "America/Bogota", "2024-01-06 00:30:00", 7, True),
        ("2024-03-10T06:59:59", "America/New_York", "2024-03-10 01:59:59", 1, True),
        ("2024-03-10T07:00:00", "America/New_York", "2024-03-10 03:00:00", 1, True),
        ("2024-11-04T05:00:00", "America/New_York", "2024-11-04 00:00:00", 2, False),
    ],
)
def test_local_fields(spark, utc, zone, local, weekday, weekend):
    for session_zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        try:
            t = seconds(utc)
            df = localize_stops(stops_at(spark, (50, 50), start=t, end=t + 3600), zones(spark).where("false"), "CO", zone)
            r = df.withColumn("text", F.col("stop_datetime").cast("string")).first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert (r.text, r.weekday, r.weekend) == (local, weekday, weekend)
        day = dt.datetime.fromisoformat(local)
        assert (r.date, r.year, r.month, r.day, r.hour) == (day.date(), day.year, day.month, day.day, day.hour)
        assert r.end_date == r.end_stop_datetime.date()


@pytest.mark.parametrize("value", ["1e300", "Infinity", "NaN", "95", "-1000000"])
def test_points_off_the_globe_make_no_polygon(spark, value):
    outline = f"POLYGON ((0 0, 1 0, 1 {value}, 0 0))"
    found = localize_stops(stops_at(spark, (0.1, 0.5)), zones(spark, ("CO", "America/Lima", outline)), "CO", "UTC")
    assert rows(found, "timezone") == [(None,)]
