"""Side tables that may be broadcast: written, measured, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import shared_path

#: A side table of more bytes than this is joined without a broadcast.
BROADCAST_BYTES = 32 << 20


def materialised(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that it has real
    statistics and a lost executor re-reads it."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_table(df: DataFrame, label: str, most: int = BROADCAST_BYTES) -> DataFrame:
    """``materialised``, with a broadcast hint if its rows hold at most ``most``
    bytes as text; beyond that Spark chooses by the statistics of the files."""
    table = materialised(df, label)
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    held = table.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return F.broadcast(table) if held <= most else table
