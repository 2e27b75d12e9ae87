"""Dense row numbering in a given order without a single-partition window.

``row_number() over (order by k)`` moves every row into one task. Here the
rows are range-partitioned on the order, numbered inside each partition
(``monotonically_increasing_id`` packs the partition index in the high bits
and the position in the low 33 bits), and shifted by the number of rows in
all earlier partitions. The per-partition counts form a table with one row
per partition, a bound we choose, so it is safe to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.small import side_table
from tessera.session import checkpoint_root

_LOW_BITS = 33


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    out: str = "row_idx",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = 0, 1, 2, ... following ``order``.

    Rows equal on ``order`` are ordered by a hash of the whole row, so the
    numbering is deterministic and a value shared by a large share of the
    rows still spreads over many range partitions.

    The locally numbered rows are checkpointed to the shared checkpoint
    folder first: the range bounds come from sampling, so both uses of the
    numbered rows (counts and rows) must see one materialised copy, and the
    copy survives the loss of an executor.
    """
    spark = df.sparkSession
    checkpoint_root(spark)  # make sure a reliable checkpoint folder is set
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    mono = F.monotonically_increasing_id()
    keys = [*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    local = (
        df.repartitionByRange(n_parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("__mono", mono)
        .withColumn("__part", F.shiftright("__mono", _LOW_BITS))
        .withColumn("__pos", F.col("__mono") - F.shiftleft("__part", _LOW_BITS))
        .drop("__mono")
        .checkpoint(eager=True)
    )
    sizes = local.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    numbered = local.join(F.broadcast(offsets), "__part")
    return numbered.select(
        *[F.col(c) for c in df.columns], (F.col("__off") + F.col("__pos")).alias(out)
    )


def number_in_input_order(df: DataFrame, file: str = "file", start: str = "start", out: str = "row_idx") -> DataFrame:
    """Add ``out`` = 0, 1, 2, ... in the order of the input: file by file (by
    path), and in a file from top to bottom. Nothing is sorted or moved.

    ``df`` is a file scan, filtered or projected at will, with the path and the
    start of the split each row comes from (``readers.read_lines``). Rows of a split
    lie together in their task, so one pass counts the rows per split, and the
    running sum over splits, a table with a row for each, gives the number of
    the first row of a split. The second pass adds it. Both passes cut the
    same files into the same splits.
    """
    numbered = df.withColumn("__mono", F.monotonically_increasing_id())
    part = F.shiftright("__mono", _LOW_BITS)
    splits = numbered.groupBy(part.alias("__p"), F.col(file).alias("__f"), F.col(start).alias("__s")).agg(
        F.min("__mono").alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    before = Window.orderBy("__f", "__s").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")
    shifts = side_table(splits.select("__p", F.xxhash64("__f").alias("__h"), "__s", shift.alias("__shift")), "splits")
    same = (part == F.col("__p")) & (F.xxhash64(F.col(file)) == F.col("__h")) & (F.col(start) == F.col("__s"))
    return numbered.join(shifts, same).select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__mono") + F.col("__shift")).alias(out))
