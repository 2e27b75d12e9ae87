"""Physical-plan checks: join strategies, pushdown, pruning, no Python on the
native path, and the same answers under different shuffle widths."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL, plan_text


def q(spark, name):
    return entry.queries()[name](spark, SF_SMALL)


def test_broadcast_and_merge_joins(spark):
    assert "BroadcastHashJoin" in plan_text(q(spark, "join_broadcast"))
    merge = plan_text(q(spark, "join_sort_merge"))
    assert "SortMergeJoin" in merge and "BroadcastHashJoin" not in merge


def test_columns_pruned(spark):
    pruned = plan_text(q(spark, "project_columns"))
    assert "ReadSchema: struct<event_id:bigint,ts" not in pruned
    assert "ReadSchema: struct<event_id:bigint>" in pruned


@pytest.mark.parametrize("name", ["hourly_avg_pickup", "longest_trip_window", "longest_trip_argmax", "tfidf"])
def test_native_path_has_no_python(spark, name):
    text = plan_text(q(spark, name))
    assert "EvalPython" not in text and "PythonUDF" not in text


def test_udf_path_uses_arrow(spark):
    assert "ArrowEvalPython" in plan_text(q(spark, "udf_haversine"))


def test_bucketed_tables_join_without_shuffle(spark):
    # Tables this small would be broadcast; switch that off to see the
    # plan large tables get.
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k, None) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        from tessera.plans import ingest, taxi

        trips_table, vendors_table = ingest.convert_to_bucketed(spark, SF_SMALL)
        text = plan_text(taxi.join_inner(spark.table(trips_table), spark.table(vendors_table)))
    finally:
        for k, v in zip(keys, old):
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "Bucketed: true" in text and "SortMergeJoin" in text
    assert "Exchange hashpartitioning(trip_id" not in text


@pytest.mark.parametrize("name", [
    "hourly_avg_pickup", "longest_trip_window", "longest_trip_argmax", "window_max", "tfidf_sparse",
    "class_counts", "number_rows", "except_all", "stratified_split_hash", "sort_asc",
])
def test_same_answer_for_any_shuffle_width(spark, name):
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for width in ("1", "4", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            results.append(sorted(tuple(r) for r in q(spark, name).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]


def test_box_predicates_reach_the_parquet_scan(spark):
    from tessera.plans import ingest, taxi
    from tessera.sources import readers

    trips_path, _ = ingest.convert_to_parquet(spark, SF_SMALL)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # print whole filter lists
    try:
        text = plan_text(taxi.hourly_avg_pickup(readers.read_parquet(spark, trips_path)))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(trip_start_lat,40.0)" in text
    assert "LessThanOrEqual(trip_end_long,-71.0)" in text
    assert "ReadSchema: struct<trip_start_time:timestamp_ntz,trip_end_time:timestamp_ntz," in text
    assert "trip_cost" not in text.split("ReadSchema:")[1].split("\n")[0]


def test_bounded_join_broadcasts_the_limited_side(spark):
    from tessera.operators import joins
    from tessera.sources import fixtures as fx

    t, v = fx.trips(spark, SF_SMALL), fx.vendors(spark, SF_SMALL)
    assert "BroadcastHashJoin" in plan_text(joins.join_bounded(t, v, "trip_id", 50, ["trip_id"]))


@pytest.fixture
def no_broadcast(spark):
    """The plans that large tables get."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k, None) for k in keys]
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in zip(keys, old):
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_q1_has_no_single_task_aggregate(spark):
    assert "Coalesce" not in plan_text(q(spark, "hourly_avg_pickup"))


@pytest.mark.parametrize("name", ["longest_trip_window", "longest_trip_sql", "longest_trip_argmax"])
def test_argmax_limits_groups_before_the_shuffle(spark, no_broadcast, name):
    text = plan_text(q(spark, name)).split("Initial Plan")[0]
    assert "WindowGroupLimit" in text and "SortAggregate" not in text
    assert text.count("Scan parquet") <= 2  # trips and vendors, both from events


def test_building_q2_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-q2", "plan only")
    try:
        q(spark, "longest_trip_window")
        q(spark, "longest_trip_sql")
        q(spark, "longest_trip_argmax")
        # Reading footers for the schema is the only thing that may run.
        plain = len(tracker.getJobIdsForGroup("build-q2"))
        spark.sparkContext.setJobGroup("footers", "schemas")
        for _ in range(6):
            spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
        assert plain <= len(tracker.getJobIdsForGroup("footers"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_window_max_does_not_deal_rows_by_group(spark, no_broadcast):
    text = plan_text(q(spark, "window_max"))
    assert "BroadcastHashJoin" in text and "hashpartitioning(vendor_id" not in text


def test_features_are_row_local(spark, no_broadcast):
    text = plan_text(q(spark, "tfidf"))
    assert "Exchange hashpartitioning(doc_id" not in text


def test_assembled_vectors_are_sparse(spark):
    from pyspark.ml.linalg import SparseVector

    from tessera.plans import text as plans_text
    from tessera.sources import fixtures as fx

    rows = plans_text.tfidf_vectors(fx.complaints(spark, SF_SMALL), 200).collect()
    assert any(isinstance(r.features, SparseVector) for r in rows)
    assert all(r.features.size == 200 for r in rows)


def test_mlp_test_rows_need_one_shuffle(spark, no_broadcast):
    from tessera.plans import learn
    from tessera.plans.registry import features_path

    ds = learn.dataset(spark.read.parquet(features_path(spark, SF_SMALL)))
    text = plan_text(learn.test_rows(ds)).split("Initial Plan")[0]
    assert text.count("Exchange hashpartitioning") == 1
