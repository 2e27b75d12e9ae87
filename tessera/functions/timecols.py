"""Time-of-day columns that do not depend on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_of(ts) -> Column:
    """Hour 0-23 of a wall-clock (``timestamp_ntz``) value."""
    return F.hour(F.col(ts) if isinstance(ts, str) else ts)


def hour_label(ts) -> Column:
    """Zero-padded hour, "00".."23".

    Built from ``hour`` rather than ``date_format(ts, 'HH')``: the latter
    shifts zone-less values through the session zone and reports "04" for
    03:30 on a spring-forward day.
    """
    return F.lpad(hour_of(ts).cast("string"), 2, "0")
