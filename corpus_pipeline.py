"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame; ``run`` writes each result as Parquet under the shared
checkpoint folder and rereads it as the next stage's ``docs``. All stages but
the last return the columns of ``documents`` (extra ones included); the last
adds size, source_size, target and taken, and keeps the documents the mix
takes words from. Null or empty texts pass the filters, an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, line_dedup, mixing, near_dedup, quality
from tessera.llm._common import scratch
from tessera.sources.tables import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return quality.keep_accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents go; the text changes, rows stay.
    ``n_chars``, if there, follows the text."""
    cut = line_dedup.drop_frequent_lines(docs)
    text = F.when(F.col("row.text").isNull(), F.col("row.text")).otherwise(F.col("kept"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length("kept").cast(kind)).otherwise(F.col("row.n_chars"))
    return cut.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.keep_one_of_each(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents with the words taken of each."""
    mixed = mixing.mix(docs).where("taken > 0")
    own = ["size", "source_size", "target", "taken"]
    return mixed.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in own], *own)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_dedup_stage),
    ("near dedup", near_dedup_stage),
    ("decontamination", decontaminate_stage),
    ("source mixing", mixing_stage),
]

#: A fitted classifier, sketches and an automaton are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
