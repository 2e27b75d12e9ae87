"""Taxi-trip queries: hourly pick-up averages (Q1), longest trip per vendor
(Q2) in its arg-max, window and SQL forms, and the join-strategy study.

Inputs are the ``trips`` and ``vendors`` DataFrames (see
``tessera.sources.fixtures`` for how they come from the test tables, or
``tessera.sources.readers`` for CSV/Parquet files in the original layout).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.geo import (
    haversine_compat,
    haversine_compat_udf,
    haversine_km,
    haversine_km_udf,
    minutes_between,
)
from tessera.functions.predicates import clean_trip, in_box
from tessera.functions.timecols import hour_label, hour_of
from tessera.operators import groups, joins

DISTANCES = {"compat": haversine_compat, "km": haversine_km}
# The same formulas through Arrow UDFs: the slow path, for comparison only.
UDF_DISTANCES = {"compat_udf": haversine_compat_udf, "km_udf": haversine_km_udf}
# Distances are compared for equality (ties), so they are rounded to a fixed
# number of decimals first; every engine then agrees on which trips tie.
DISTANCE_DECIMALS = 6
POINTS = ("trip_start_long", "trip_start_lat", "trip_end_long", "trip_end_lat")


def distance(kind: str = "km"):
    if kind in UDF_DISTANCES:
        return F.round(UDF_DISTANCES[kind](*[F.col(c) for c in POINTS]), DISTANCE_DECIMALS)
    return F.round(DISTANCES[kind](*POINTS), DISTANCE_DECIMALS)


def duration():
    return minutes_between("trip_start_time", "trip_end_time")


# --- Q1 -------------------------------------------------------------------

def hourly_avg_pickup(trips: DataFrame) -> DataFrame:
    """Mean pick-up longitude/latitude per start hour over clean trips.

    24 groups: the partial aggregate leaves at most 24 rows per map task, so
    the shuffle is tiny whatever the input size or skew.
    """
    return groups.avg_by(
        trips.where(clean_trip()),
        hour_of("trip_start_time"),
        {"avg_start_long": "trip_start_long", "avg_start_lat": "trip_start_lat"},
        key_name="start_hour",
    )


# --- scalar columns --------------------------------------------------------

def fn_hour(trips: DataFrame) -> DataFrame:
    return trips.select("trip_id", hour_of("trip_start_time").alias("start_hour"))


def fn_hour_label(trips: DataFrame) -> DataFrame:
    return trips.select("trip_id", hour_label("trip_start_time").alias("hour_label"))


def trip_duration(trips: DataFrame) -> DataFrame:
    return trips.select("trip_id", duration().alias("duration"))


def trip_distance(trips: DataFrame, kind: str) -> DataFrame:
    return trips.select("trip_id", distance(kind).alias("distance"))


def trip_distance_udf(trips: DataFrame, kind: str = "km") -> DataFrame:
    """The same distance through the Arrow UDF (benchmark slow path)."""
    return trips.select("trip_id", distance(f"{kind}_udf").alias("distance"))


# --- filters and projections --------------------------------------------

def filter_bbox(trips: DataFrame) -> DataFrame:
    return trips.where(in_box())


def filter_clean_trips(trips: DataFrame) -> DataFrame:
    return trips.where(clean_trip())


def project_columns(trips: DataFrame) -> DataFrame:
    return trips.select("trip_id", "trip_start_long", "trip_start_lat")


def sort_asc(trips: DataFrame) -> DataFrame:
    """All trips by start time (trip_id breaks ties); a range-partitioned
    sort, so no task holds more than its range."""
    return trips.select("trip_id", "trip_start_time", "trip_cost").orderBy(
        "trip_start_time", "trip_id"
    )


# --- Q2 --------------------------------------------------------------------

def _trips_with_vendor(trips: DataFrame, vendors: DataFrame, kind: str) -> DataFrame:
    # Only the four columns Q2 needs cross the trip_id shuffle.
    metrics = trips.select("trip_id", distance(kind).alias("distance"), duration().alias("duration"))
    return metrics.join(vendors, "trip_id", "inner").select(
        "vendor_id", "trip_id", "distance", "duration"
    )


def longest_trip_argmax(trips: DataFrame, vendors: DataFrame, kind: str = "compat") -> DataFrame:
    """One longest clean trip per vendor; ties go to the longer duration,
    then the larger trip_id. Each map task keeps one row per vendor."""
    joined = _trips_with_vendor(trips.where(clean_trip()), vendors, kind)
    best = groups.argmax_by(joined, "vendor_id", "distance", ties="one", tie_break=["duration", "trip_id"])
    return best.orderBy("vendor_id")


def longest_trip_window(trips: DataFrame, vendors: DataFrame, kind: str = "compat") -> DataFrame:
    """Every in-box trip whose distance equals its vendor's maximum (ties
    kept, also those of repeated trip or vendor rows). Equivalent to
    ``max(distance) over (partition by vendor_id)`` and a filter, but each
    task keeps only its own best trips per vendor before the shuffle by
    vendor. One scan of the trips; nothing runs while the plan is built.
    """
    joined = _trips_with_vendor(trips.where(in_box()), vendors, kind)
    return groups.argmax_by(joined, "vendor_id", "distance", ties="all")


def window_max(trips: DataFrame, vendors: DataFrame, kind: str = "compat") -> DataFrame:
    """Each in-box trip with its vendor's maximum distance."""
    joined = _trips_with_vendor(trips.where(in_box()), vendors, kind)
    return groups.with_group_max(joined, "vendor_id", "distance", "max_distance")


LONGEST_TRIP_SQL = """
SELECT vendor_id, trip_id, distance, duration
FROM (
  SELECT v.vendor_id, m.trip_id, m.distance, m.duration,
         rank() OVER (PARTITION BY v.vendor_id ORDER BY m.distance DESC) AS place
  FROM {metrics} m
  JOIN {vendors} v ON m.trip_id = v.trip_id
  WHERE m.distance IS NOT NULL
)
WHERE place = 1
"""


def longest_trip_sql(spark: SparkSession, trips: DataFrame, vendors: DataFrame, kind: str = "compat") -> DataFrame:
    """Q2 in SQL over temp views, with the plan of ``longest_trip_window``.
    The views live only as long as the statement is analysed."""
    metrics = trips.where(in_box()).select(
        "trip_id", distance(kind).alias("distance"), duration().alias("duration")
    )
    return spark.sql(LONGEST_TRIP_SQL, metrics=metrics, vendors=vendors)


# --- joins -----------------------------------------------------------------

JOIN_BUILD_ROWS = 50


def join_inner(trips: DataFrame, vendors: DataFrame) -> DataFrame:
    return joins.join_inner(trips, vendors, "trip_id")


def join_hot_keys(trips: DataFrame, vendors: DataFrame) -> DataFrame:
    """The same join, with keys that hold many rows dealt over several tasks."""
    return joins.join_hot_keys(trips, vendors, "trip_id")


def limit_build_side(vendors: DataFrame, n: int = JOIN_BUILD_ROWS) -> DataFrame:
    return joins.limit_build_side(vendors, n, ["trip_id"])


def join_broadcast(trips: DataFrame, vendors: DataFrame, n: int = JOIN_BUILD_ROWS) -> DataFrame:
    """Trips joined with the first ``n`` vendor rows, broadcast (bounded by n)."""
    return joins.join_bounded(trips, vendors, "trip_id", n, ["trip_id"])


def join_sort_merge(trips: DataFrame, vendors: DataFrame, n: int = JOIN_BUILD_ROWS) -> DataFrame:
    """The same join forced to sort-merge, for comparison."""
    return joins.join_sort_merge(trips, limit_build_side(vendors, n), "trip_id")
