"""Named queries: ``name -> callable(spark, sf_dir) -> DataFrame``.

Each one reads the given tables (or files Spark writes from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import ingest, learn, model, taxi, text
from tessera.sources import fixtures as fx
from tessera.sources import readers
from tessera.streaming import trips as streams

Query = Callable[[SparkSession, str], DataFrame]


def _on_trips(fn) -> Query:
    return lambda spark, sf_dir: fn(fx.trips(spark, sf_dir))


def _on_complaints(fn) -> Query:
    return lambda spark, sf_dir: fn(fx.complaints(spark, sf_dir))


def _on_vectors(fn) -> Query:
    return lambda spark, sf_dir: fn(spark.read.parquet(features_path(spark, sf_dir)))


def features_path(spark: SparkSession, sf_dir: str) -> str:
    """The feature table of a data set, written once per application."""
    return fx.written(spark, sf_dir, "features", lambda: learn.feature_table(spark, fx.complaints(spark, sf_dir)))


def model_path(spark: SparkSession, sf_dir: str) -> str:
    """The stored classifier of a data set, fitted once per application."""
    return fx.written(spark, sf_dir, "model", lambda: model.stored(spark, fx.complaints(spark, sf_dir)))


def _rounded(fn, column: str, decimals: int = 6):
    return lambda c: fn(c).withColumn(column, F.round(column, decimals))


def _on_trips_vendors(fn) -> Query:
    return lambda spark, sf_dir: fn(fx.trips(spark, sf_dir), fx.vendors(spark, sf_dir))


QUERIES: dict[str, Query] = {
    # Q1
    "hourly_avg_pickup": _on_trips(taxi.hourly_avg_pickup),
    # scalar functions
    "fn_hour": _on_trips(taxi.fn_hour),
    "fn_hour_label": _on_trips(taxi.fn_hour_label),
    "trip_duration": _on_trips(taxi.trip_duration),
    "haversine_km": _on_trips(lambda t: taxi.trip_distance(t, "km")),
    "haversine_compat": _on_trips(lambda t: taxi.trip_distance(t, "compat")),
    "udf_haversine": _on_trips(lambda t: taxi.trip_distance_udf(t, "km")),
    # filters, projections, sort
    "filter_bbox": _on_trips(taxi.filter_bbox),
    "filter_clean_trips": _on_trips(taxi.filter_clean_trips),
    "project_columns": _on_trips(taxi.project_columns),
    "sort_asc": _on_trips(taxi.sort_asc),
    "scan_parquet": _on_trips(lambda t: t),
    # Q2
    "longest_trip_argmax": _on_trips_vendors(taxi.longest_trip_argmax),
    "longest_trip_window": _on_trips_vendors(taxi.longest_trip_window),
    "window_max": _on_trips_vendors(taxi.window_max),
    "longest_trip_sql": lambda spark, d: taxi.longest_trip_sql(spark, fx.trips(spark, d), fx.vendors(spark, d)),
    # joins
    "join_inner": _on_trips_vendors(taxi.join_inner),
    "join_hot_keys": _on_trips_vendors(taxi.join_hot_keys),
    "join_broadcast": _on_trips_vendors(taxi.join_broadcast),
    "join_sort_merge": _on_trips_vendors(taxi.join_sort_merge),
    "limit_build_side": lambda spark, d: taxi.limit_build_side(fx.vendors(spark, d)),
    # sources and sinks
    "scan_text": ingest.scan_text,
    "parse_delimited": ingest.parse_delimited,
    "scan_csv": ingest.scan_csv,
    "scan_csv_dropmalformed": ingest.scan_csv_dropmalformed,
    "count_dropmalformed": ingest.count_dropmalformed,
    "scan_csv_multiline": ingest.scan_csv_multiline,
    "filter_bbox_clustered": ingest.filter_bbox_clustered,
    "csv_to_parquet": ingest.csv_to_parquet,
    "csv_to_parquet_vendors": ingest.csv_to_parquet_vendors,
    "hourly_avg_pickup_csv": ingest.hourly_avg_pickup_csv,
    "hourly_avg_pickup_text": ingest.hourly_avg_pickup_text,
    "longest_trip_csv": ingest.longest_trip_csv,
    "longest_trip_bucketed": ingest.longest_trip_bucketed,
    "longest_trip_argmax_text": ingest.longest_trip_argmax_text,
    # text features
    "valid_records_file": lambda spark, d: text.valid_records(fx.complaints_from_text(spark, d)),
    "word_count_file": lambda spark, d: text.word_count(fx.complaints_from_text(spark, d)),
    "filter_valid_records": _on_complaints(text.valid_records),
    "clean_text": _on_complaints(text.cleaned),
    "tokenize_explode": _on_complaints(text.tokens),
    "remove_stopwords": _on_complaints(text.content_tokens),
    "word_count": _on_complaints(text.word_count),
    "top_k_words": _on_complaints(text.top_k_words),
    "lexicon": _on_complaints(text.lexicon),
    "filter_to_lexicon": _on_complaints(text.lexicon_tokens),
    "term_frequency": _on_complaints(text.term_frequency),
    "document_frequency": _on_complaints(text.document_frequency),
    "idf": _on_complaints(_rounded(text.idf, "idf")),
    "tf_double_norm": _on_complaints(text.tf_double_norm),
    "tfidf": _on_complaints(_rounded(text.tfidf, "weight")),
    "tfidf_sparse": _on_complaints(text.tfidf_sparse),
    # labels, splits, set operations, classifier
    "label_index": _on_vectors(learn.label_index),
    "dedup_rows": _on_vectors(learn.dedup_rows),
    "class_counts": _on_vectors(learn.class_counts),
    "class_cardinality": _on_vectors(learn.class_cardinality),
    "distinct_labels": _on_vectors(learn.distinct_labels),
    "stratified_sample": _on_vectors(learn.stratified_sample),
    "stratified_split_hash": _on_vectors(learn.stratified_split_hash),
    "stratified_split_exact": _on_vectors(learn.stratified_split_exact),
    "except_distinct": _on_vectors(learn.except_distinct),
    "except_all": _on_vectors(learn.except_all),
    "number_rows": _on_complaints(learn.number_rows),
    "number_lines": lambda spark, d: learn.number_lines(readers.read_lines(spark, fx.complaints_text_path(spark, d))),
    "mlp_train_predict": _on_vectors(learn.mlp_predictions),
    "mlp_accuracy": _on_vectors(learn.mlp_accuracy),
    "mlp_score_stored": lambda spark, d: model.score_stored(fx.complaints(spark, d), model_path(spark, d)),
    # streaming forms
    "hourly_avg_pickup_stream": streams.hourly_avg_pickup_stream,
    "longest_trip_stream": streams.longest_trip_stream,
}
