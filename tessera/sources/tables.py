"""Loading the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a test-data folder, e.g. ``table(spark, d, "events")``."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Session setting: number of partitions that text records are dealt into
#: before CPU-heavy work, for inputs in few unsplittable files. Unset (the
#: default) leaves the scan's splits as they are.
TEXT_PARTITIONS = "spark.tessera.textPartitions"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows into ``TEXT_PARTITIONS`` hash partitions if that is set.

    An explicit choice of the user, never one made from measured sizes: the
    plan is the same on every cluster. Partitioning on ``xxhash64(keys)``
    rather than the keys leaves later aggregations their own shuffle.
    """
    n = df.sparkSession.conf.get(TEXT_PARTITIONS, None)
    if not n:
        return df
    return df.repartition(int(n), F.xxhash64(*keys)) if keys else df.repartition(int(n))
