"""Set operations and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right`` (SQL EXCEPT)."""
    return left.subtract(right)


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Multiset difference (SQL EXCEPT ALL): a row occurring ``a`` times in
    ``left`` and ``b`` times in ``right`` is kept ``max(a - b, 0)`` times."""
    return left.exceptAll(right)


def dedup_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop repeated rows (on ``subset`` if given); partial aggregation
    removes local duplicates before the shuffle."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def vector_key(vector: str) -> Column:
    """The size and the non-zero entries of an MLlib vector with their full
    values: equal for equal vectors, sparse or dense."""
    v = F.unwrap_udt(vector)
    sparse = F.zip_with(v.getField("indices"), v.getField("values"), lambda i, x: F.struct(i.alias("i"), x.alias("x")))
    dense = F.transform(v.getField("values"), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    entries = F.filter(F.when(v.getField("type") == 0, sparse).otherwise(dense), lambda e: e["x"] != 0)
    return F.struct(F.coalesce(v.getField("size"), F.size(v.getField("values"))).alias("size"), entries.alias("entries"))


def dedup_vectors(df: DataFrame, vector: str, others: Sequence[str]) -> DataFrame:
    """Drop rows that repeat ``others`` and, entry by entry and bit by bit (but
    for the sign of a zero), the vector. The shuffle goes by the hash of the
    whole key; within a task Spark compares the keys themselves.

    Spark sorts the rows by the key, so a hash of it goes first: long keys
    with the same beginnings are compared only where their hashes are equal."""
    keyed = df.withColumn("__key", vector_key(vector)).withColumn("__hash", F.xxhash64(*others, "__key"))
    return keyed.dropDuplicates(["__hash", *others, "__key"]).drop("__hash", "__key")
