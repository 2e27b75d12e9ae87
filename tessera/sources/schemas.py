"""Declared schemas of the raw inputs (no inference on the read path)."""

from pyspark.sql import types as T

# Wall-clock times without a zone: taxi meters record local time, so the
# zone-less type keeps hour() and comparisons independent of the session zone
# (a zoned type loses the hour 03:00-04:00 on a spring-forward day).
TRIPS = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("trip_start_time", T.TimestampNTZType()),
        T.StructField("trip_end_time", T.TimestampNTZType()),
        T.StructField("trip_start_long", T.DoubleType()),
        T.StructField("trip_start_lat", T.DoubleType()),
        T.StructField("trip_end_long", T.DoubleType()),
        T.StructField("trip_end_lat", T.DoubleType()),
        T.StructField("trip_cost", T.DoubleType()),
    ]
)

VENDORS = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("vendor_id", T.StringType()),
    ]
)

# Raw complaint records are "date,label,comment" lines.
COMPLAINT_FIELDS = ("date", "label", "comment")

TRIP_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("lang", T.StringType()),
    T.StructField("text", T.StringType()),
])
