"""Great-circle distance and trip duration as native Column expressions.

They compile into whole-stage code; the Arrow UDF at the bottom exists only
as the slow-path comparison for the benchmark and for SQL registration.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARTH_RADIUS_KM = 6371.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float) -> Column:
    a = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(
        F.sin((lon2 - lon1) / 2), 2
    )
    # Rounding can push a slightly outside [0, 1]; sqrt would give NaN.
    a = F.least(F.lit(1.0), F.greatest(F.lit(0.0), a))
    return F.lit(2 * radius) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def haversine_km(lon1, lat1, lon2, lat2, radius: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km between points given in degrees."""
    lon1, lat1, lon2, lat2 = (F.radians(_col(c)) for c in (lon1, lat1, lon2, lat2))
    return _haversine(lon1, lat1, lon2, lat2, radius)


def haversine_compat(lon1, lat1, lon2, lat2, radius: float = EARTH_RADIUS_KM) -> Column:
    """The same formula fed with raw degrees, as the original taxi queries
    did (they passed degrees to sin/cos). Kept only to reproduce their
    numbers; it is not a distance."""
    return _haversine(_col(lon1), _col(lat1), _col(lon2), _col(lat2), radius)


def minutes_between(start, end) -> Column:
    """(end - start) in minutes as a double, exact to the microsecond.

    ``timestampdiff`` works on zone-less timestamps (``unix_micros`` does not).
    """
    micros = F.timestamp_diff("MICROSECOND", _col(start), _col(end))
    return micros / F.lit(60_000_000.0)


def _haversine_np(lon1, lat1, lon2, lat2, radius, to_radians):
    arrs = [np.asarray(s, dtype="float64") for s in (lon1, lat1, lon2, lat2)]
    if to_radians:
        arrs = [np.radians(a) for a in arrs]
    lon1, lat1, lon2, lat2 = arrs
    a = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin((lon2 - lon1) / 2) ** 2
    a = np.clip(a, 0.0, 1.0)
    return 2 * radius * np.arctan2(np.sqrt(a), np.sqrt(1 - a))


@F.pandas_udf(T.DoubleType())
def haversine_km_udf(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    """Arrow-batched UDF with the ``haversine_km`` formula (slow path)."""
    return pd.Series(_haversine_np(lon1, lat1, lon2, lat2, EARTH_RADIUS_KM, True))


@F.pandas_udf(T.DoubleType())
def haversine_compat_udf(
    lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series
) -> pd.Series:
    """Arrow-batched UDF with the ``haversine_compat`` formula (slow path)."""
    return pd.Series(_haversine_np(lon1, lat1, lon2, lat2, EARTH_RADIUS_KM, False))


def register_sql_functions(spark: SparkSession) -> None:
    """Make the UDF forms callable from SQL text."""
    spark.udf.register("haversine_km_udf", haversine_km_udf)
    spark.udf.register("haversine_compat_udf", haversine_compat_udf)


def z_order(x, y, x_range: tuple[float, float], y_range: tuple[float, float], bits: int = 8) -> Column:
    """A number that is near for near points: the bits of both coordinates'
    cells, interleaved. Points outside the ranges count as on their border; a
    null coordinate gives null."""

    def cell(c, low: float, high: float) -> Column:
        share = (_col(c) - low) / (high - low) * (1 << bits)
        return F.floor(F.greatest(F.least(share, F.lit(float((1 << bits) - 1))), F.lit(0.0))).cast("int")

    def spread_bits(n: Column, shift: int) -> list[Column]:
        return [F.shiftleft(F.shiftright(n, i).bitwiseAND(F.lit(1)), 2 * i + shift) for i in range(bits)]

    parts = spread_bits(cell(x, *x_range), 0) + spread_bits(cell(y, *y_range), 1)
    known = _col(x).isNotNull() & _col(y).isNotNull()
    return F.when(known, sum(parts[1:], parts[0]))
