"""Column helpers and scratch tables shared by the operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import shared_path

# The six ASCII white-space characters [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does the same on pure ASCII and is faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def text_key(text: Column) -> list[Column]:
    """128 bits that identify a text (null and empty differ): columns k1, k2.

    Rows are recognised by what they say, so repeated or missing ids do no
    harm and copies share one decision.
    """
    return [F.xxhash64(text, text.isNull()).alias("k1"), F.xxhash64(F.lit(1), text, text.isNull()).alias("k2")]


def count_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs, 0 for null, as long."""
    body = F.btrim(text, F.lit(ASCII_SPACE))
    return F.when(F.coalesce(body, F.lit("")) == "", F.lit(0)).otherwise(
        F.size(F.split(body, SPACES, -1))
    ).cast("long")


CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage on storage that survives lost executors, and lets Spark
    delete this job's shuffle files as soon as the table is written.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    before = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)
