"""The reference's logical inputs (trips, vendors, complaints) derived from the
given test tables.

``events`` has one row per event with a unique ``event_id`` and zone-less
times; each event becomes one taxi trip. Coordinates are multiples of 1/128,
so sums of them are exact in any order. The data is dirty on purpose: trips
outside the bounding box, trips that end before they start, trips with equal
coordinates, and trips without a vendor. The CSV rendering adds malformed
fields so that the PERMISSIVE and DROPMALFORMED read modes differ.

The same definitions are written as SQL CTEs in ``tessera.plans.oracle``.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import is_live, shared_path
from tessera.sources import readers, schemas, sinks
from tessera.sources.tables import spread, table

# Fixed values of the fixture definition (shared with the SQL oracle).
BAD_TIME_MOD, BAD_TIME_REM = 89, 3  # start time rendered as "n/a"
BAD_LAT_MOD, BAD_LAT_REM = 97, 5  # start latitude rendered as "NA"
NO_VENDOR_MOD = 11  # every 11th event has no vendor row
SKIPPED_YEAR_MOD = 10  # complaint dated 2009 (invalid) when doc_id % 10 == 0
KEEP_COMMAS_MOD = 7  # comment keeps its commas when doc_id % 7 == 0


def trip_columns() -> dict[str, Column]:
    eid, uid = F.col("event_id"), F.col("user_id")

    def coord(base: int, expr: Column, modulus: int) -> Column:
        return F.lit(base) + (expr % modulus) / F.lit(128.0)

    end_offset = F.expr("make_dt_interval(0, 0, 0, (event_id * 7919) % 3720 - 120)")
    return {
        "trip_id": eid.cast("string"),
        "trip_start_time": F.col("ts"),
        "trip_end_time": F.col("ts") + end_offset,
        "trip_start_long": coord(-82, eid * 37, 1536),
        "trip_start_lat": coord(39, eid * 53, 896),
        "trip_end_long": coord(-82, eid * 101 + uid, 1536),
        "trip_end_lat": coord(39, eid * 29 + uid, 896),
        "trip_cost": F.col("value"),
    }


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as typed columns, straight from the ``events`` Parquet scan."""
    cols = trip_columns()
    return table(spark, sf_dir, "events").select(*[c.alias(n) for n, c in cols.items()])


def vendor_rows(events: DataFrame) -> DataFrame:
    """(trip_id, vendor_id) of a batch or a stream of events."""
    return events.where(F.col("event_id") % NO_VENDOR_MOD != 0).select(
        F.col("event_id").cast("string").alias("trip_id"),
        (F.lit(1) + F.col("user_id") % 2).cast("string").alias("vendor_id"),
    )


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(trip_id, vendor_id); two vendors, so each holds about half the rows."""
    return vendor_rows(table(spark, sf_dir, "events"))


def _wall_clock_text(ts: Column) -> Column:
    # cast(timestamp_ntz as string) ignores the session zone; date_format
    # does not, so it is avoided here.
    return F.substring(ts.cast("string"), 1, 19)


def trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips rendered as header-less CSV text lines (column ``value``)."""
    cols = trip_columns()
    eid = F.col("event_id")
    start = F.when(eid % BAD_TIME_MOD == BAD_TIME_REM, F.lit("n/a")).otherwise(
        _wall_clock_text(cols["trip_start_time"])
    )
    start_lat = F.when(eid % BAD_LAT_MOD == BAD_LAT_REM, F.lit("NA")).otherwise(
        cols["trip_start_lat"].cast("string")
    )
    fields = [
        cols["trip_id"],
        start,
        _wall_clock_text(cols["trip_end_time"]),
        cols["trip_start_long"].cast("string"),
        start_lat,
        cols["trip_end_long"].cast("string"),
        cols["trip_end_lat"].cast("string"),
        cols["trip_cost"].cast("string"),
    ]
    return table(spark, sf_dir, "events").select(F.concat_ws(",", *fields).alias("value"))


def vendor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vendors(spark, sf_dir)
    return v.select(F.concat_ws(",", "trip_id", "vendor_id").alias("value"))


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw complaint records ``date,label,comment`` as (doc_id, line).

    The label is the document language. Each document is one record, so
    line breaks inside a comment do not split it.
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "doc_id")
    year = F.when(F.col("doc_id") % SKIPPED_YEAR_MOD == 0, F.lit("2009")).otherwise(F.lit("2015"))
    comment = F.when(F.col("doc_id") % KEEP_COMMAS_MOD == 0, F.col("text")).otherwise(
        F.replace(F.col("text"), F.lit(","), F.lit(" "))
    )
    line = F.concat(year, F.lit("-03-10,"), F.col("lang"), F.lit(","), comment)
    return docs.select("doc_id", line.alias("line"))


def complaint_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaint records as text lines (column ``value``); line breaks inside a
    comment become spaces, so that a record is one line."""
    flat = F.translate("line", "\n\r", "  ")
    return complaints(spark, sf_dir).select(flat.alias("value"))


# Files rendered from the tables are written once per (application, folder)
# and reused until they are released.
_written: dict[tuple[str, str, str], str] = {}
_lock = threading.Lock()


def written(spark: SparkSession, sf_dir: str, kind: str, make) -> str:
    """The path ``make()`` returned the first time it was asked for."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    with _lock:
        if key not in _written or not is_live(spark, _written[key]):
            _written[key] = make()
        return _written[key]


def _materialize(spark: SparkSession, sf_dir: str, kind: str, lines: DataFrame) -> str:
    return written(spark, sf_dir, kind, lambda: sinks.write_text(lines, shared_path(spark, f"{kind}-csv")))


def complaints_text_path(spark: SparkSession, sf_dir: str) -> str:
    return _materialize(spark, sf_dir, "complaints", complaint_lines(spark, sf_dir))


def complaints_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_complaints(spark, complaints_text_path(spark, sf_dir))


def trips_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of header-less trip CSV files rendered from ``events``."""
    return _materialize(spark, sf_dir, "trips", trip_lines(spark, sf_dir))


def vendors_csv_path(spark: SparkSession, sf_dir: str) -> str:
    return _materialize(spark, sf_dir, "vendors", vendor_lines(spark, sf_dir))


def trips_from_csv(spark: SparkSession, sf_dir: str, mode: str = "PERMISSIVE") -> DataFrame:
    return readers.read_csv(spark, trips_csv_path(spark, sf_dir), schemas.TRIPS, mode=mode)


def vendors_from_csv(spark: SparkSession, sf_dir: str, mode: str = "PERMISSIVE") -> DataFrame:
    return readers.read_csv(spark, vendors_csv_path(spark, sf_dir), schemas.VENDORS, mode=mode)


def documents_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of CSV files with a header and quoted whole texts, line breaks
    included; every 89th id is malformed."""

    def write() -> str:
        bad = F.col("doc_id") % BAD_TIME_MOD == BAD_TIME_REM
        rows = table(spark, sf_dir, "documents").select(
            F.when(bad, F.lit("n/a")).otherwise(F.col("doc_id").cast("string")).alias("doc_id"), "lang", "text"
        )
        path = shared_path(spark, "documents-csv")
        options = {"header": True, "quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        rows.write.options(**options).csv(path)
        return path

    return written(spark, sf_dir, "documents", write)
