"""Stratified sampling and repeatable train/test splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.small import side_table

HASH_BUCKETS = 10_000


def stratified_sample(df: DataFrame, col: str, fractions: Mapping, seed: int) -> DataFrame:
    """``sampleBy``: each row is kept with the fraction of its stratum;
    strata missing from the mapping get fraction 0.

    The seed is per partition, so the sample depends on partitioning; use
    ``hash_split`` when it must be repeatable.
    """
    return df.sampleBy(col, dict(fractions), seed)


def hash_bucket(keys: Sequence[str], seed: int, buckets: int = HASH_BUCKETS) -> Column:
    """A bucket in [0, buckets) from the MD5 of the seed and key columns.

    MD5 is used (not Spark's xxhash) so that the same bucket can be
    recomputed by any engine.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    h32 = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h32, F.lit(buckets))


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    train_fraction: float = 0.8,
    seed: int = 10,
    out: str = "split",
) -> DataFrame:
    """Tag each row 'train' or 'test' from a hash of its key.

    Independent of partitioning and re-execution, and equal rows always land
    on the same side. Within every stratum the train share converges to
    ``train_fraction`` (a per-row Bernoulli trial, like ``sampleBy``).
    """
    cut = int(round(train_fraction * HASH_BUCKETS))
    bucket = hash_bucket(keys, seed)
    return df.withColumn(out, F.when(bucket < cut, F.lit("train")).otherwise(F.lit("test")))


def exact_split(
    df: DataFrame,
    stratum: str,
    keys: Sequence[str],
    train_fraction: float = 0.8,
    seed: int = 10,
    out: str = "split",
) -> DataFrame:
    """Tag the round(fraction * n) rows of each stratum that have the smallest
    seeded hash 'train', the others 'test' (halves round up).

    No stratum is sorted or gathered. One pass counts rows per stratum and the
    hash's first 16 bits; the running sum over at most 65 536 counts tells in
    which of them the cut lies, and how deep. Only that bucket's rows, one in
    65 536, are ranked, which gives the exact cutting hash of each stratum. The
    second pass compares. ``keys`` tell rows apart: rows that agree on all of
    them stay on one side, and only there may the number be exceeded.
    """
    keyed = df.withColumn("__md", F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(f"`{k}`").cast("string") for k in keys])))
    bucket = F.substring("__md", 1, 4)
    counts = keyed.groupBy(F.col(f"`{stratum}`").alias("__s"), bucket.alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    ordered = Window.partitionBy("__s").orderBy("__b")
    need = F.floor(F.lit(train_fraction) * F.sum("__n").over(Window.partitionBy("__s")) + F.lit(0.5))
    running = counts.select("__s", "__b", "__n", F.sum("__n").over(ordered).alias("__upto"), need.alias("__need"))
    at_cut = (F.col("__upto") >= F.col("__need")) & (F.col("__upto") - F.col("__n") < F.col("__need"))
    cut = side_table(running.where(at_cut).select("__s", "__b", (F.col("__need") - F.col("__upto") + F.col("__n")).alias("__take")), "cut")
    inside = keyed.select(F.col(f"`{stratum}`").alias("__t"), "__md").join(
        cut, F.col("__t").eqNullSafe(F.col("__s")) & (bucket == F.col("__b"))
    )
    place = F.row_number().over(Window.partitionBy("__s").orderBy("__md"))
    last = inside.withColumn("__place", place).where(F.col("__place") == F.col("__take"))
    limits = side_table(last.select(F.col("__s").alias("__l"), F.col("__md").alias("__last")), "limits")
    tagged = keyed.join(limits, F.col(f"`{stratum}`").eqNullSafe(F.col("__l")), "left")
    train = F.coalesce(F.col("__md") <= F.col("__last"), F.lit(False))
    return tagged.select(*[F.col(f"`{c}`") for c in df.columns], F.when(train, F.lit("train")).otherwise(F.lit("test")).alias(out))
