"""Label indexing, de-duplication, train/test splits and the multilayer
perceptron classifier over the TF-IDF vectors.

The split is by a hash of the row content (label and feature entries), so it
does not change with partitioning or re-execution, and duplicate rows can
never fall on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.predicates import valid_record
from tessera.operators import numbering, sampling, sets
from tessera.plans import text
from tessera.session import shared_path

TRAIN_FRACTION = 0.8
SPLIT_SEED = 10
# Fixed values of the classifier: hidden layers, iterations, block size, seed.
HIDDEN_LAYERS = (40, 30, 20)
MAX_ITER = 100
BLOCK_SIZE = 128
MLP_SEED = 1234

ROW = ["label_f", "label", "features_key"]


def label_indexer(vectors: DataFrame) -> StringIndexerModel:
    """Labels -> 0, 1, ... by descending frequency (ties alphabetically).

    Fitting aggregates label counts; only the distinct labels reach the
    driver."""
    indexer = StringIndexer(
        inputCol="label_f", outputCol="label", handleInvalid="skip", stringOrderType="frequencyDesc"
    )
    return indexer.fit(vectors)


@dataclass
class Dataset:
    labelled: DataFrame  # every document with a feature vector
    rows: DataFrame  # de-duplicated (label_f, label, features, features_key)
    labels: list[str]  # label_f by index


def feature_table(spark: SparkSession, complaints: DataFrame, k: int = text.LEXICON_SIZE) -> str:
    """Write the feature vectors (one row per document) once to the shared
    folder: indexer, split, every L-BFGS pass and the scoring read that table
    instead of running the text pipeline again, and a lost executor re-reads
    it. Returns the path."""
    path = shared_path(spark, "features")
    text.tfidf_vectors(complaints, k).write.parquet(path)
    return path


def dataset(vectors: DataFrame) -> Dataset:
    """vectors: (doc_id, label_f, features, features_key). Adds label indices
    and the de-duplicated rows."""
    model = label_indexer(vectors)
    labelled = model.transform(vectors)
    rows = sets.dedup_vectors(labelled.select("label_f", "label", "features", "features_key"), "features", ["label_f", "label"])
    return Dataset(labelled, rows, list(model.labels))


def with_split(ds: Dataset) -> DataFrame:
    return sampling.hash_split(ds.rows, ["label_f", "features_key"], TRAIN_FRACTION, SPLIT_SEED)


def train_rows(ds: Dataset) -> DataFrame:
    return with_split(ds).where(F.col("split") == "train").drop("split")


def test_rows(ds: Dataset) -> DataFrame:
    """The other rows: those are distinct, so this is all rows EXCEPT the
    training rows."""
    return with_split(ds).where(F.col("split") == "test").drop("split")


# --- registered queries ----------------------------------------------------

def label_index(vectors: DataFrame) -> DataFrame:
    """(label_f, label, n): the index each label got and its frequency."""
    ds = dataset(vectors)
    return ds.labelled.groupBy("label_f", "label").agg(F.count(F.lit(1)).alias("n"))


def dedup_rows(vectors: DataFrame) -> DataFrame:
    return dataset(vectors).rows.select(*ROW)


def class_counts(vectors: DataFrame) -> DataFrame:
    """(split, label_f, n) for the whole set and for each side of the split."""
    split = with_split(dataset(vectors))
    whole = split.groupBy("label_f").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("all").alias("split"), "label_f", "n"
    )
    sides = split.groupBy("split", "label_f").agg(F.count(F.lit(1)).alias("n"))
    return whole.unionByName(sides)


def class_cardinality(vectors: DataFrame) -> DataFrame:
    return dataset(vectors).rows.agg(F.count_distinct("label_f").alias("n_classes"))


def distinct_labels(vectors: DataFrame) -> DataFrame:
    return sets.distinct_values(dataset(vectors).rows, ["label_f", "label"])


def stratified_sample(vectors: DataFrame) -> DataFrame:
    """``sampleBy`` with a fraction of 0.8 for every label."""
    ds = dataset(vectors)
    fractions = {float(i): TRAIN_FRACTION for i in range(len(ds.labels))}
    return sampling.stratified_sample(ds.rows, "label", fractions, SPLIT_SEED).select(*ROW)


def stratified_split_hash(vectors: DataFrame) -> DataFrame:
    return with_split(dataset(vectors)).select(*ROW, "split")


def stratified_split_exact(vectors: DataFrame) -> DataFrame:
    """Exactly round(0.8 n) training rows of every label."""
    rows = dataset(vectors).rows.select(*ROW)
    return sampling.exact_split(rows, "label", ["label_f", "features_key"], TRAIN_FRACTION, SPLIT_SEED)


def except_distinct(vectors: DataFrame) -> DataFrame:
    """All distinct rows EXCEPT the training rows."""
    ds = dataset(vectors)
    return sets.except_distinct(ds.rows.select(*ROW), train_rows(ds).select(*ROW))


def except_all(vectors: DataFrame) -> DataFrame:
    """Every document row (duplicates kept) minus the training rows."""
    ds = dataset(vectors)
    return sets.except_all(ds.labelled.select(*ROW), train_rows(ds).select(*ROW))


def number_rows(complaints: DataFrame) -> DataFrame:
    """Valid records numbered 0.. in doc_id order (distributed)."""
    return numbering.number_rows(text.valid_records(complaints).select("doc_id"), ["doc_id"])


def number_lines(lines: DataFrame) -> DataFrame:
    """(doc_id, row_idx): valid records of complaint files numbered 0.. in the
    order of the files. lines: (value, file, start) of ``readers.read_lines``."""
    records = lines.select(F.md5("value").alias("doc_id"), F.col("value").alias("line"), "file", "start").where(valid_record("line"))
    return numbering.number_in_input_order(records.select("doc_id", "file", "start")).select("doc_id", "row_idx")


# --- classifier --------------------------------------------------------------

def train_mlp(train: DataFrame, n_features: int, n_classes: int, cache: bool = True, max_iter: int = MAX_ITER):
    """Fit the perceptron (layers n_features-40-30-20-n_classes).

    L-BFGS passes over the training rows once per iteration, so they are
    persisted (memory, spilling to disk) for the fit and released after it.
    """
    layers = [n_features, *HIDDEN_LAYERS, n_classes]
    trainer = MultilayerPerceptronClassifier(
        maxIter=max_iter, layers=layers, blockSize=BLOCK_SIZE, seed=MLP_SEED,
        featuresCol="features", labelCol="label",
    )
    if cache:
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return trainer.fit(train)
    finally:
        if cache:
            train.unpersist()


def mlp_predictions(vectors: DataFrame, cache: bool = True, max_iter: int = MAX_ITER) -> DataFrame:
    """(label_f, label, prediction) for the test rows."""
    ds = dataset(vectors)
    model = train_mlp(train_rows(ds), text.LEXICON_SIZE, len(ds.labels), cache, max_iter)
    return model.transform(test_rows(ds)).select("label_f", "label", "prediction")


def mlp_accuracy(vectors: DataFrame, cache: bool = True, max_iter: int = MAX_ITER) -> DataFrame:
    """One row: accuracy on the test rows and their count."""
    pred = mlp_predictions(vectors, cache, max_iter)
    return pred.agg(
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n_test"),
    )
