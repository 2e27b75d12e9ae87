"""Equi-joins with an explicit strategy.

The strategy is set per query with hints, never with a session-wide ``SET``
(which would leak into every later query of the session).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that a sketch tracks and that may be dealt over several tasks.
TRACKED, HEAVY = 10_000, 256
#: A heavy key is cut so that a task gets about this part of its fair share.
FINER = 4


def join_inner(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner equi-join; Spark chooses the strategy from statistics (and AQE
    revisits it with run-time sizes)."""
    return left.join(right, on, "inner")


def limit_build_side(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """The first ``n`` rows in a fixed order: a repeatable bounded side.

    ``limit`` without an order picks whatever rows the first tasks return.
    """
    return df.orderBy(*order).limit(n)


def join_bounded(
    big: DataFrame,
    side: DataFrame,
    on: str | Sequence[str],
    n: int,
    order: Sequence[Column | str],
    how: str = "inner",
) -> DataFrame:
    """Join ``big`` with the first ``n`` rows of ``side``, broadcast.

    ``n`` is the proven bound of the broadcast: choose it so that n rows fit
    an executor (the join study uses 50). For more, use ``join_sort_merge``.
    """
    return big.join(F.broadcast(limit_build_side(side, n, order)), on, how)


def join_sort_merge(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Force a sort-merge join for this join only (``merge`` hint)."""
    return left.hint("merge").join(right, on, how)


def heavy_keys(df: DataFrame, on: Sequence[str], partitions: int) -> dict[int, float]:
    """Hashes of the keys that hold more than half a task's fair share of the
    rows, with their shares: from one mergeable frequent-items sketch
    (``approx_top_k``) per task, at most ``HEAVY`` keys."""
    valid = df.dropna(subset=list(on)).select(F.xxhash64(*on).alias("h"))
    found = valid.agg(F.count(F.lit(1)), F.call_function("approx_top_k", F.col("h"), F.lit(HEAVY), F.lit(TRACKED))).first()
    n, top = found[0], found[1] or []
    return {r["item"]: r["count"] / n for r in top if r["count"] > 1 and r["count"] / n > 0.5 / partitions}


def join_hot_keys(left: DataFrame, right: DataFrame, on: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """Inner equi-join that does not rely on adaptive execution for hot keys.

    A key that is heavy on the left is cut into parts there, and so on the
    right; every left part meets every right part in a cell of its own, a row
    being copied once per part of the other side. All other keys have one part
    each and are not copied. The parts of a row follow from its place in its
    input partition, so a task that runs again deals it alike.
    """
    on = [on] if isinstance(on, str) else list(on)
    spark = left.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [heavy_keys(df, on, n) for df in (left, right)]
    hot = sorted(set(shares[0]) | set(shares[1]))
    if not hot:
        return left.join(right, on, "inner")
    rows = []
    for h in hot:
        a, b = (max(1, round(FINER * n * s.get(h, 0))) for s in shares)
        while a * b > FINER * FINER * n and max(a, b) > 1:  # cells enough for an even deal
            a, b = (max(1, a // 2), b) if a >= b else (a, max(1, b // 2))
        rows.append((h, a, b))
    # At most 2 * HEAVY rows of three numbers.
    parts = F.broadcast(spark.createDataFrame(rows, "__h bigint, __a int, __b int"))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        cut = df.withColumn("__row", F.monotonically_increasing_id()).withColumn("__k", F.xxhash64(*on))
        known = cut.join(parts, F.col("__k") == F.col("__h"), "left")
        mine = F.when(F.col("__h").isNull(), F.lit(0)).otherwise(F.pmod("__row", F.col(own)).cast("int"))
        copies = F.when(F.col("__h").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col(other) - 1))
        return known.select(*[F.col(f"`{c}`") for c in df.columns], mine.alias(f"{own}_part"), F.explode(copies).alias(f"{other}_part"))

    keys = [*on, "__a_part", "__b_part"]
    return dealt(left, "__a", "__b").join(dealt(right, "__b", "__a"), keys, "inner").drop("__a_part", "__b_part")
