"""Readers: text lines, delimited records, CSV with a declared schema, Parquet.

All of them are lazy DataFrame scans, so Catalyst prunes columns and pushes
filters into the file scan (Parquet row-group skipping, CSV parse pruning).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.schemas import TRIP_TIME_FORMAT

READ_MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``; files are split across tasks."""
    return spark.read.text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``read_text`` with the path of the file and the start of the split that
    a line comes from: (value, file, start)."""
    return read_text(spark, path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    mode: str = "PERMISSIVE",
    header: bool = False,
    timestamp_format: str = TRIP_TIME_FORMAT,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a declared schema (never inferred: inference is an extra pass).

    PERMISSIVE turns unparsable fields into NULL, DROPMALFORMED drops the
    record (see ``_well_formed``), FAILFAST stops the job. With ``header`` the first
    line of each file is left out. With ``multi_line`` quoted fields may hold line
    breaks; a file is then read by one task, record by record.
    """
    mode = mode.upper()
    if mode not in READ_MODES:
        raise ValueError(f"mode must be one of {READ_MODES}")
    if mode == "DROPMALFORMED":
        if header or multi_line:
            return _well_formed_records(spark, path, schema, header, timestamp_format, multi_line)
        return _well_formed(read_text(spark, path), schema, timestamp_format)
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("multiLine", multi_line)
        .option("mode", mode)
        .option("timestampNTZFormat", timestamp_format)
        .option("timestampFormat", timestamp_format)
        .csv(path)
    )


def _corrupt_name(schema: T.StructType) -> str:
    bad = "_malformed"
    while bad in schema.names:
        bad += "_"
    return bad


def _well_formed_records(
    spark: SparkSession, path: str, schema: T.StructType, header: bool, timestamp_format: str, multi_line: bool
) -> DataFrame:
    """The well-formed records of CSV files, by the file reader's own notion of
    a record, which knows where a file begins and which line breaks are quoted.

    Every column is asked for in the filter on the corrupt-record field, whatever
    the query on top selects, and the reader's own pruning is off: it would
    otherwise look only at the fields a query needs and find other records
    malformed.
    """
    bad = _corrupt_name(schema)
    full = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    records = (
        spark.read.schema(full)
        .option("header", header)
        .option("enforceSchema", True)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", bad)
        .option("timestampNTZFormat", timestamp_format)
        .option("timestampFormat", timestamp_format)
        .csv(path)
    )
    asked = F.concat_ws("", *[F.col(f"`{c}`").isNull().cast("string") for c in schema.names])
    return records.where(F.col(f"`{bad}`").isNull() & (F.length(asked) > 0)).select(*[f"`{c}`" for c in schema.names])


def _well_formed(lines: DataFrame, schema: T.StructType, timestamp_format: str) -> DataFrame:
    """The records of CSV lines in which every field parses and the field count
    is right.

    The CSV source's own DROPMALFORMED converts only the columns a query asks
    for, so which records it drops changes with the projection. Here a record
    is parsed whole by ``from_csv`` with a corrupt-record field, and kept if that
    is empty: any count, projection or filter on top sees the same records.
    Records are single lines, and no line is a header.
    """
    bad = _corrupt_name(schema)
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": bad,
        "timestampNTZFormat": timestamp_format,
        "timestampFormat": timestamp_format,
    }
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    full = f"{ddl}, `{bad}` string"
    records = lines.where(F.trim("value") != "")
    parsed = records.select(F.from_csv("value", full, options).alias("r"))
    return parsed.where(F.col("r").getField(bad).isNull()).select(
        *[F.col("r").getField(f.name).alias(f.name) for f in schema.fields]
    )


def read_complaints(spark: SparkSession, path: str) -> DataFrame:
    """Complaint files, one record per line: (doc_id, line). The id is the MD5
    of the line, so it does not depend on splits or file order; repeated lines
    share it."""
    return read_text(spark, path).select(F.md5("value").alias("doc_id"), F.col("value").alias("line"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet; the schema comes from the file footers."""
    return spark.read.parquet(path)


def _typed(field: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return field
    # try_cast: a bad field becomes NULL instead of failing the job under ANSI.
    return field.try_cast(dtype)


def parse_delimited(
    lines: DataFrame,
    schema: T.StructType,
    sep: str = ",",
    strict_fields: int | None = None,
    column: str = "value",
) -> DataFrame:
    """Split text lines positionally and cast each field to the schema's type.

    This is the plain ``line.split(sep)`` parse: no quoting rules. With
    ``strict_fields=n`` only lines with exactly ``n`` fields are kept.
    Unparsable fields become NULL (``try_cast``).
    """
    parts = F.split(F.col(column), _regex_literal(sep), -1)
    out = lines.select(parts.alias("__parts"))
    if strict_fields is not None:
        out = out.where(F.size("__parts") == strict_fields)
    cols = [
        _typed(F.get(F.col("__parts"), i), field.dataType).alias(field.name)
        for i, field in enumerate(schema.fields)
    ]
    return out.select(*cols)


def _regex_literal(sep: str) -> str:
    special = set(".^$*+?()[]{}|\\")
    return "".join("\\" + ch if ch in special else ch for ch in sep)
