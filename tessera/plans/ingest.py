"""Ingest queries: raw text lines, positional parsing, CSV with declared
schema in PERMISSIVE and DROPMALFORMED modes, and CSV -> Parquet conversion.

The CSV inputs are rendered from the ``events`` table once per session and
written under the shared checkpoint folder (see ``fixtures.trips_csv_path``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import taxi
from tessera.session import shared_path
from tessera.sources import fixtures as fx
from tessera.sources import readers, schemas, sinks


def scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_text(spark, fx.trips_csv_path(spark, sf_dir))


def parse_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines split on commas and cast field by field (bad fields NULL)."""
    return readers.parse_delimited(scan_text(spark, sf_dir), schemas.TRIPS)


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.trips_from_csv(spark, sf_dir, mode="PERMISSIVE")


def scan_csv_dropmalformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.trips_from_csv(spark, sf_dir, mode="DROPMALFORMED")


def count_dropmalformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates over the DROPMALFORMED reader that ask for few columns, or
    none: they must see the records that a full read sees."""
    trips = scan_csv_dropmalformed(spark, sf_dir)
    return trips.agg(F.count(F.lit(1)).alias("n")).join(
        trips.select("trip_id").agg(F.min("trip_id").alias("first_id"), F.max("trip_id").alias("last_id"))
    )


def scan_csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents from quoted CSV records that span lines, malformed
    ones dropped."""
    path = fx.documents_csv_path(spark, sf_dir)
    docs = readers.read_csv(spark, path, schemas.DOCUMENTS, mode="DROPMALFORMED", header=True, multi_line=True)
    return docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def filter_bbox_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box filter over trips converted in order of place: row groups
    outside the box are skipped by their statistics."""
    path = sinks.csv_to_clustered(spark, fx.trips_csv_path(spark, sf_dir), shared_path(spark, "clustered"))
    return taxi.filter_bbox(readers.read_parquet(spark, path))


def convert_to_parquet(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Run the conversion job into a new folder; returns (trips, vendors)."""
    out = shared_path(spark, "parquet")
    return sinks.csv_to_parquet(
        spark, fx.trips_csv_path(spark, sf_dir), fx.vendors_csv_path(spark, sf_dir), out
    )


def csv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Convert both CSV inputs to Parquet, then read the trips back."""
    trips_path, _ = convert_to_parquet(spark, sf_dir)
    return readers.read_parquet(spark, trips_path)


def csv_to_parquet_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same conversion, the vendors read back."""
    _, vendors_path = convert_to_parquet(spark, sf_dir)
    return readers.read_parquet(spark, vendors_path)


def hourly_avg_pickup_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 over the CSV input (PERMISSIVE: bad fields fail the filter)."""
    return taxi.hourly_avg_pickup(scan_csv(spark, sf_dir))


def hourly_avg_pickup_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 over text lines parsed positionally (the line-by-line form)."""
    return taxi.hourly_avg_pickup(parse_delimited(spark, sf_dir))


def longest_trip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 (window form) over both CSV inputs."""
    return taxi.longest_trip_window(scan_csv(spark, sf_dir), fx.vendors_from_csv(spark, sf_dir))


def vendors_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = readers.read_text(spark, fx.vendors_csv_path(spark, sf_dir))
    return readers.parse_delimited(lines, schemas.VENDORS)


def longest_trip_argmax_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 in its line-parsing form: both inputs read as text lines and split
    positionally, clean trips only, one longest trip per vendor."""
    return taxi.longest_trip_argmax(parse_delimited(spark, sf_dir), vendors_from_text(spark, sf_dir))


def convert_to_bucketed(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> tuple[str, str]:
    """Run the conversion job into tables bucketed by trip_id (same bucket
    count on both sides); returns (trips table, vendors table)."""
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = shared_path(spark, "bucketed")
    return sinks.csv_to_bucketed_tables(
        spark, fx.trips_csv_path(spark, sf_dir), fx.vendors_csv_path(spark, sf_dir),
        out, uuid.uuid4().hex[:12], n,
    )


def longest_trip_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 (window form) over the bucketed tables: the trips-vendors join
    reads both sides bucket by bucket, with no shuffle."""
    trips_table, vendors_table = convert_to_bucketed(spark, sf_dir)
    return taxi.longest_trip_window(spark.table(trips_table), spark.table(vendors_table))
