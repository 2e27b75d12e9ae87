"""Grouped aggregation, arg-max per group, per-group maxima and top-k.

Averages and maxima are partial (map-side) plus final aggregates, arg-max is a
ranking window with a map-side limit: a group holding a third of all rows
ships one row (or its ties) per map task, and no group is gathered into one
task. No plan depends on a size measured or guessed here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.small import side_table


def _cols(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def avg_by(df: DataFrame, key: Column | str, averages: dict[str, Column | str], key_name=None) -> DataFrame:
    """``groupBy(key).agg(avg(...))`` with named outputs, sorted by key."""
    key_col = F.col(key) if isinstance(key, str) else key
    if key_name:
        key_col = key_col.alias(key_name)
    aggs = [F.avg(c).alias(name) for name, c in averages.items()]
    out = df.groupBy(key_col).agg(*aggs)
    return out.orderBy(out.columns[0])


def argmax_by(
    df: DataFrame, keys: str | Sequence[str], value: str, ties: str = "all", tie_break: Sequence[str] = ()
) -> DataFrame:
    """Rows holding the largest ``value`` of their group.

    ``ties='all'`` keeps every row equal to the group maximum (``rank() = 1``),
    ``ties='one'`` one row per group, the largest by (value, *tie_break, then
    the other columns; ``row_number() = 1``). NULL values never win. Spark
    plans a WindowGroupLimit below the shuffle: each task keeps its own best
    rows per group, and only those are sent to the group's task.
    """
    keys = _cols(keys)
    if ties not in ("all", "one"):
        raise ValueError("ties must be 'all' or 'one'")
    order = [F.desc(value)]
    if ties == "one":
        rest = [c for c in df.columns if c not in keys and c != value and c not in tie_break]
        order += [F.desc(c) for c in (*tie_break, *rest)]
    place = (F.rank() if ties == "all" else F.row_number()).over(Window.partitionBy(*keys).orderBy(*order))
    valued = df.where(F.col(value).isNotNull())
    return valued.withColumn("__place", place).where(F.col("__place") == 1).select(*df.columns)


def with_group_max(df: DataFrame, keys: str | Sequence[str], value: str, out: str) -> DataFrame:
    """Every row plus the maximum of ``value`` over its group, i.e.
    ``max(value) over (partition by keys)`` without dealing the rows by group.

    The maxima, one row per group, come from partial aggregates (one row per
    group and task in the shuffle) and are written; if they are small enough
    they meet the rows as a broadcast, so a group of any size stays where its
    rows are. With more groups than that (``side_table``) Spark joins by
    statistics, and adaptive execution splits skewed keys.
    """
    keys = _cols(keys)
    maxima = df.groupBy(*keys).agg(F.max(value).alias(out))
    best = side_table(maxima, "group-max").alias("__r")
    joined = df.alias("__l").join(best, _key_match(keys), "inner")
    return joined.select(*_left_cols(df), F.col(f"__r.`{out}`"))


def _key_match(keys: list[str]) -> list[Column]:
    # Null-safe, like a window partition: NULL keys form one group.
    return [F.col(f"__l.`{k}`").eqNullSafe(F.col(f"__r.`{k}`")) for k in keys]


def _left_cols(df: DataFrame) -> list[Column]:
    return [F.col(f"__l.`{c}`") for c in df.columns]


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """The first ``k`` rows by ``order`` (give a unique tie-break column).

    Planned as TakeOrderedAndProject: each task keeps its own k best rows,
    and only k x tasks rows reach the final merge.
    """
    return df.orderBy(*order).limit(k)
