"""Row predicates as Column expressions (pushed into the scan where possible)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bounding box of valid pick-up/drop-off points (inclusive).
LAT_MIN, LAT_MAX = 40.0, 45.0
LONG_MIN, LONG_MAX = -80.0, -71.0

TRIP_POINTS = (
    ("trip_start_long", "trip_start_lat"),
    ("trip_end_long", "trip_end_lat"),
)


def in_box(points=TRIP_POINTS) -> Column:
    """Every (long, lat) point lies inside the box, bounds included.

    Written as plain comparisons so Parquet gets them as pushed filters;
    a NULL coordinate makes the predicate NULL, which drops the row.
    """
    cond = F.lit(True)
    for long_col, lat_col in points:
        lng, lat = F.col(long_col), F.col(lat_col)
        cond = cond & (lat >= LAT_MIN) & (lat <= LAT_MAX) & (lng >= LONG_MIN) & (lng <= LONG_MAX)
    return cond


def clean_trip(
    start: str = "trip_start_time",
    end: str = "trip_end_time",
    points=TRIP_POINTS,
) -> Column:
    """In the box, starts before it ends, and both coordinates moved."""
    (slong, slat), (elong, elat) = points
    return (
        in_box(points)
        & (F.col(start) < F.col(end))
        & (F.col(slong) != F.col(elong))
        & (F.col(slat) != F.col(elat))
    )


def valid_record(line: str = "line", sep: str = ",", n_fields: int = 3) -> Column:
    """A raw complaint line is usable when it has exactly ``n_fields`` fields,
    a non-empty last field (the comment) and a date starting with "201".

    A comment that contains the separator makes the line invalid: that is
    the record format's rule, kept as is. A line holds a whole document, so
    it is cut into one field too many at most, and only if the date is right.
    """
    c = F.col(line)
    n = F.size(F.split(c, re.escape(sep), n_fields + 1))
    return c.startswith("201") & ~c.endswith(sep) & (n == n_fields)
