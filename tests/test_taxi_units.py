"""Edge cases of the trip predicates, time columns and Q1/Q2 operators."""

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions.geo import EARTH_RADIUS_KM, haversine_compat, haversine_km, minutes_between
from tessera.functions.predicates import clean_trip, in_box
from tessera.functions.timecols import hour_label, hour_of
from tessera.operators import groups
from tessera.plans import taxi
from tessera.sources import schemas

T0 = dt.datetime(2015, 3, 10, 6, 39, 54)


def trip(tid, s_long, s_lat, e_long, e_lat, start=T0, minutes=5.0, cost=1.0):
    return (tid, start, start + dt.timedelta(minutes=minutes), s_long, s_lat, e_long, e_lat, cost)


def trips_df(spark, rows):
    return spark.createDataFrame(rows, schemas.TRIPS)


def test_box_bounds_are_inclusive(spark):
    rows = [
        trip("a", -80.0, 40.0, -71.0, 45.0),  # exactly on the bounds: kept
        trip("b", -80.0001, 40.0, -71.0, 45.0),
        trip("c", -75.0, 39.9999, -75.5, 41.0),
        trip("d", -75.0, None, -75.5, 41.0),  # NULL never passes
    ]
    kept = [r.trip_id for r in trips_df(spark, rows).where(in_box()).collect()]
    assert kept == ["a"]


def test_clean_trip_drops_equal_points_and_times(spark):
    rows = [
        trip("ok", -74.0, 40.7, -73.9, 40.8),
        trip("same_time", -74.0, 40.7, -73.9, 40.8, minutes=0),
        trip("backwards", -74.0, 40.7, -73.9, 40.8, minutes=-3),
        trip("same_long", -74.0, 40.7, -74.0, 40.8),
        trip("same_lat", -74.0, 40.7, -73.9, 40.7),
    ]
    kept = [r.trip_id for r in trips_df(spark, rows).where(clean_trip()).collect()]
    assert kept == ["ok"]


def test_hour_ignores_session_zone_in_dst_gap(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Athens")
    try:
        df = spark.sql("SELECT timestamp_ntz'2015-03-29 03:30:00' AS ts")
        row = df.select(hour_of("ts").alias("h"), hour_label("ts").alias("l")).first()
        assert (row.h, row.l) == (3, "03")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_minutes_between_is_exact(spark):
    df = spark.createDataFrame([(T0, T0 + dt.timedelta(minutes=6, seconds=6, microseconds=3))], "s timestamp_ntz, e timestamp_ntz")
    got = df.select(minutes_between("s", "e").alias("m")).first().m
    assert got == (366 * 1_000_000 + 3) / 60_000_000.0


def test_hourly_avg_pickup_groups_by_start_hour(spark):
    rows = [
        trip("1", -74.0, 40.5, -73.0, 41.0, start=dt.datetime(2015, 3, 1, 7, 0, 0)),
        trip("2", -73.0, 41.5, -74.0, 41.0, start=dt.datetime(2015, 3, 1, 7, 59, 59)),
        trip("3", -75.0, 42.0, -74.0, 41.0, start=dt.datetime(2015, 3, 1, 8, 0, 0)),
        trip("4", -75.0, 42.0, -75.0, 41.0, start=dt.datetime(2015, 3, 1, 8, 0, 0)),  # dirty
    ]
    out = [tuple(r) for r in taxi.hourly_avg_pickup(trips_df(spark, rows)).collect()]
    assert out == [(7, -73.5, 41.0), (8, -75.0, 42.0)]


def _py_haversine(lon1, lat1, lon2, lat2, radians):
    if radians:
        lon1, lat1, lon2, lat2 = map(math.radians, (lon1, lat1, lon2, lat2))
    a = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    a = min(1.0, max(0.0, a))
    return 2 * EARTH_RADIUS_KM * math.atan2(math.sqrt(a), math.sqrt(1 - a))


coord = st.tuples(st.floats(-180, 180), st.floats(-90, 90))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(coord, coord), min_size=1, max_size=30))
def test_haversine_properties(spark, pairs):
    rows = [(p[0], p[1], q[0], q[1]) for p, q in pairs]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    out = df.select(
        haversine_km("a", "b", "c", "d").alias("d1"),
        haversine_km("c", "d", "a", "b").alias("d2"),
        haversine_compat("a", "b", "c", "d").alias("raw"),
    ).collect()
    for (a, b, c, d), r in zip(rows, out):
        assert 0.0 <= r.d1 <= math.pi * EARTH_RADIUS_KM + 1e-6
        assert r.d1 == pytest.approx(r.d2, abs=1e-6)
        assert r.d1 == pytest.approx(_py_haversine(a, b, c, d, True), abs=1e-6)
        assert r.raw == pytest.approx(_py_haversine(a, b, c, d, False), abs=1e-6)


def test_one_degree_of_latitude(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    d = df.select(haversine_km("a", "b", "c", "d").alias("d")).first().d
    assert d == pytest.approx(111.195, abs=1e-3)


def test_argmax_ties(spark):
    rows = [("1", "t1", 10.0, 3.0), ("1", "t2", 10.0, 5.0), ("1", "t3", 4.0, 9.0),
            ("2", "t4", 7.0, 1.0), ("2", "t5", 7.0, 1.0), ("2", "t6", None, 1.0)]
    df = spark.createDataFrame(rows, "vendor_id string, trip_id string, distance double, duration double")
    every = groups.argmax_by(df, "vendor_id", "distance", ties="all")
    assert sorted(r.trip_id for r in every.collect()) == ["t1", "t2", "t4", "t5"]
    one = groups.argmax_by(df, "vendor_id", "distance", ties="one", tie_break=["duration", "trip_id"])
    assert sorted((r.vendor_id, r.trip_id) for r in one.collect()) == [("1", "t2"), ("2", "t5")]
    assert one.columns == df.columns


def test_hot_group_is_limited_before_the_shuffle(spark):
    # One vendor holds 90% of the rows: each task keeps its best rows of a
    # vendor, so what reaches the vendor's task is the ties, not the vendor.
    rows = [("hot" if i % 10 else f"v{i}", f"t{i}", float(i % 997), 1.0) for i in range(20000)]
    df = spark.createDataFrame(rows, "vendor_id string, trip_id string, distance double, duration double")
    out = groups.argmax_by(df, "vendor_id", "distance", ties="all")
    assert out.where("vendor_id = 'hot'").count() == 18 * 1  # distance 996 occurs 20 times, 18 of them hot
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_group_max_keeps_every_row(spark):
    rows = [("1", "t1", 10.0), ("1", "t2", 4.0), (None, "t3", 2.0), (None, "t4", 6.0)]
    df = spark.createDataFrame(rows, "vendor_id string, trip_id string, distance double")
    out = {r.trip_id: r.max_distance for r in groups.with_group_max(df, "vendor_id", "distance", "max_distance").collect()}
    assert out == {"t1": 10.0, "t2": 10.0, "t3": 6.0, "t4": 6.0}


@pytest.mark.parametrize("form", ["window", "sql"])
def test_longest_trip_with_repeated_trip_ids_equals_window(spark, form):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    rows = [
        trip("1", -74.0, 40.0, -73.0, 41.0, minutes=5),  # same id twice, same distance
        trip("1", -74.0, 40.0, -73.0, 41.0, minutes=9),
        trip("1", -74.5, 40.5, -74.4, 40.6, minutes=2),  # same id, shorter
        trip("2", -74.0, 40.0, -73.0, 41.0, minutes=7),  # tie with "1"
        trip("3", -75.0, 42.0, -74.9, 42.1, minutes=3),
    ]
    t = trips_df(spark, rows)
    v = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b")], schemas.VENDORS)
    if form == "window":
        ours = taxi.longest_trip_window(t, v)
    else:
        ours = taxi.longest_trip_sql(spark, t, v)
    j = taxi._trips_with_vendor(t.where(in_box()), v, "compat")
    ref = j.withColumn("m", F.max("distance").over(Window.partitionBy("vendor_id"))).where("distance = m").drop("m")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, ref.select(*ours.columns).collect()))
    assert ours.count() == 4


def test_inner_join_drops_unmatched(spark):
    t = trips_df(spark, [trip("1", -74.0, 40.7, -73.9, 40.8), trip("2", -74.0, 40.7, -73.9, 40.8)])
    v = spark.createDataFrame([("1", "a"), ("3", "b")], schemas.VENDORS)
    assert [r.trip_id for r in taxi.join_inner(t, v).collect()] == ["1"]


def test_trip_id_keeps_all_digits(spark):
    t = trips_df(spark, [trip("274878258468", -74.0, 40.7, -73.9, 40.8)])
    assert t.first().trip_id == "274878258468"
