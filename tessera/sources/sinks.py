"""Sinks: Parquet and plain text.

Writes go through Spark's file commit protocol, so a lost executor only
re-runs its tasks; nothing partial becomes visible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.geo import z_order
from tessera.functions.predicates import LAT_MAX, LAT_MIN, LONG_MAX, LONG_MIN
from tessera.session import own_table
from tessera.sources import readers, schemas


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: list[str] | None = None,
    compression: str = "snappy",
) -> str:
    """One file per task (row groups of ``parquet.block.size``, 128 MiB)."""
    writer = df.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_clustered(
    df: DataFrame,
    path: str,
    by: list[Column | str],
    rows_per_file: int = 5_000_000,
    row_group_bytes: int = 32 << 20,
    mode: str = "errorifexists",
) -> str:
    """Parquet in which rows near by ``by`` lie together: dealt by range, sorted
    within tasks, in files of at most ``rows_per_file`` rows and row groups of
    about ``row_group_bytes``. Each row group then covers a narrow range of the
    columns behind ``by``, so its statistics let filters on them skip it. The
    price is one shuffle of the table at conversion."""
    keys = [F.col(c) if isinstance(c, str) else c for c in by]
    (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .write.mode(mode)
        .option("maxRecordsPerFile", rows_per_file)
        .option("parquet.block.size", row_group_bytes)
        .parquet(path)
    )
    return path


def trips_place() -> Column:
    """Where a trip starts, as one number to cluster by. The ranges reach half
    a box beyond the bounding box on each side, so its edges are edges of cells
    and few row groups lie across them."""
    half_long, half_lat = (LONG_MAX - LONG_MIN) / 2, (LAT_MAX - LAT_MIN) / 2
    return z_order(
        "trip_start_long", "trip_start_lat",
        (LONG_MIN - half_long, LONG_MAX + half_long), (LAT_MIN - half_lat, LAT_MAX + half_lat),
    )


def csv_to_clustered(spark: SparkSession, trips_csv: str, path: str, rows_per_file: int = 5_000_000) -> str:
    """The conversion of the trips with rows clustered by starting place."""
    trips = readers.read_csv(spark, trips_csv, schemas.TRIPS, mode="DROPMALFORMED")
    return write_clustered(trips, path, [trips_place()], rows_per_file)


def write_text(lines: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write a single string column as text files, one line per row."""
    lines.write.mode(mode).text(path)
    return path


def csv_to_parquet(
    spark: SparkSession,
    trips_csv: str,
    vendors_csv: str,
    out_dir: str,
    mode: str = "errorifexists",
) -> tuple[str, str]:
    """The conversion job: both CSV inputs read with DROPMALFORMED and
    written as snappy Parquet (``<out>/trips``, ``<out>/vendors``).

    Each write is a map-only job: one output file per input split, no shuffle.
    """
    trips = readers.read_csv(spark, trips_csv, schemas.TRIPS, mode="DROPMALFORMED")
    vendors = readers.read_csv(spark, vendors_csv, schemas.VENDORS, mode="DROPMALFORMED")
    trips_out = write_parquet(trips, f"{out_dir}/trips", mode=mode)
    vendors_out = write_parquet(vendors, f"{out_dir}/vendors", mode=mode)
    return trips_out, vendors_out


def write_bucketed_table(
    df: DataFrame,
    name: str,
    path: str,
    key: str,
    buckets: int,
    mode: str = "errorifexists",
) -> str:
    """Write ``df`` as a Parquet table bucketed and sorted by ``key``.

    Tables bucketed on the same key with the same bucket count join without
    a shuffle. The rows are first hash-partitioned into ``buckets`` parts so
    each write task produces one file per bucket instead of one per
    (task, bucket) pair. The table is registered in the session catalog
    with its data under ``path`` (a shared folder).
    """
    (
        df.repartition(buckets, key)
        .write.mode(mode)
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    return own_table(df.sparkSession, name)


def csv_to_bucketed_tables(
    spark: SparkSession,
    trips_csv: str,
    vendors_csv: str,
    out_dir: str,
    suffix: str,
    buckets: int,
) -> tuple[str, str]:
    """The conversion job writing both inputs as tables bucketed by trip_id;
    returns the two table names."""
    trips = readers.read_csv(spark, trips_csv, schemas.TRIPS, mode="DROPMALFORMED")
    vendors = readers.read_csv(spark, vendors_csv, schemas.VENDORS, mode="DROPMALFORMED")
    t = write_bucketed_table(trips, f"tessera_trips_{suffix}", f"{out_dir}/trips", "trip_id", buckets)
    v = write_bucketed_table(vendors, f"tessera_vendors_{suffix}", f"{out_dir}/vendors", "trip_id", buckets)
    return t, v
