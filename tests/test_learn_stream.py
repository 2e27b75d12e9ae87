"""Classifier invariants and the streaming forms."""

import pytest

import __spark_entry__ as entry
from tessera.plans import learn
from tessera.plans.registry import features_path
from tessera.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_train_and_test_partition_the_rows(spark):
    ds = learn.dataset(spark.read.parquet(features_path(spark, SF_SMALL)))
    train, test = learn.train_rows(ds).select(*learn.ROW), learn.test_rows(ds).select(*learn.ROW)
    assert train.intersect(test).count() == 0
    assert train.union(test).distinct().count() == ds.rows.count()


def test_mlp_runs_and_scores(spark):
    vectors = spark.read.parquet(features_path(spark, SF_SMALL))
    acc = learn.mlp_accuracy(vectors, max_iter=60).first()
    again = learn.mlp_accuracy(vectors, max_iter=60).first()
    assert acc == again and acc.n_test > 0
    # Not worse than always answering with the most frequent class.
    test = learn.test_rows(learn.dataset(vectors))
    majority = max(r["count"] for r in test.groupBy("label").count().collect()) / test.count()
    assert acc.accuracy >= majority - 0.05


def test_stratified_sample_uses_a_fraction_per_label(spark):
    vectors = spark.read.parquet(features_path(spark, SF_SMALL))
    plan = learn.stratified_sample(vectors)._jdf.queryExecution().optimizedPlan().toString()
    assert "label" in plan.split("Filter")[1].split("\n")[0]


@pytest.mark.parametrize("stream,batch", [
    ("hourly_avg_pickup_stream", "hourly_avg_pickup"),
    ("longest_trip_stream", "longest_trip_argmax"),
])
def test_stream_equals_batch(spark, stream, batch):
    qs = entry.queries()
    assert qs[stream](spark, SF_SMALL).collect() == qs[batch](spark, SF_SMALL).collect()


def _split_events(spark, parts):
    from tessera.session import shared_path

    folder = shared_path(spark, "events-split")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(parts, "event_id").write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("stream,batch", [
    ("hourly_avg_pickup_stream", "hourly_avg_pickup"),
    ("longest_trip_stream", "longest_trip_argmax"),
])
def test_streams_read_tables_of_several_files(spark, stream, batch):
    qs = entry.queries()
    assert qs[stream](spark, _split_events(spark, 8)).collect() == qs[batch](spark, SF_SMALL).collect()


def test_stream_state_across_micro_batches_and_restart(spark):
    import time

    from tessera.plans import taxi
    from tessera.session import shared_path
    from tessera.streaming import trips as streams

    path = f"{_split_events(spark, 4)}/events.parquet"
    batch = taxi.hourly_avg_pickup(fx.trips(spark, SF_SMALL)).collect()
    agg = lambda: streams.hourly_avg_pickup_agg(streams.trips_stream(spark, path, files_per_batch=1))

    # Four micro-batches, one file each, in one run.
    out = streams.run_complete(agg(), "t-stream")
    assert streams.latest(spark, out).orderBy("start_hour").collect() == batch

    # Stop after two batches, then resume from the checkpoint.
    out, ckpt = shared_path(spark, "t-out"), shared_path(spark, "t-ckpt")
    q = (agg().writeStream.outputMode("complete").option("checkpointLocation", ckpt)
         .foreachBatch(streams.write_epoch(out)).trigger(processingTime="0 seconds").start())
    deadline = time.time() + 120
    while (q.lastProgress is None or q.lastProgress["batchId"] < 1) and time.time() < deadline:
        time.sleep(0.1)
    q.stop()
    streams.run_complete(agg(), "t-stream", out=out, checkpoint=ckpt)
    assert streams.latest(spark, out).orderBy("start_hour").collect() == batch


class _Source:
    """A folder to which files of a table are added over time."""

    def __init__(self, spark, rows, parts):
        from tessera.session import shared_path

        self.path = shared_path(spark, "t-source")
        self.pieces = rows.randomSplit([1.0] * parts, 3)
        self.add(0)

    def add(self, i):
        self.pieces[i].coalesce(1).write.mode("append").parquet(self.path)


def _read(spark, source):
    """The source as a stream, one file at a time."""
    from tessera.streaming import trips as streams

    return streams.events_stream(spark, source.path, 1)


def test_longest_trips_with_late_rows_and_restarts(spark):
    """Vendor rows come after their trips, trips after their vendor rows; every
    call takes in the new files only and equals the batch query over all so far."""
    from tessera.plans import taxi
    from tessera.session import shared_path
    from tessera.streaming import trips as streams

    trips, vendors = fx.trips(spark, SF_SMALL), fx.vendors(spark, SF_SMALL)
    t, v = _Source(spark, trips, 3), _Source(spark, vendors, 3)
    folder = shared_path(spark, "t-longest")
    for step in (lambda: None, lambda: v.add(1), lambda: t.add(1), lambda: (v.add(2), t.add(2)), lambda: None):
        step()
        got = streams.update_longest_trips(_read(spark, t), _read(spark, v), folder)
        want = taxi.longest_trip_argmax(spark.read.parquet(t.path), spark.read.parquet(v.path))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))
    # Rows that were joined are written once, whatever the number of calls.
    clean = taxi._trips_with_vendor(trips.where(taxi.clean_trip()), vendors, "compat")
    assert spark.read.parquet(f"{folder}/joined").count() == clean.count()


def test_longest_trips_resume_after_a_cut(spark):
    """The join query is stopped in the middle; the next call finishes it."""
    import time

    from tessera.plans import taxi
    from tessera.session import shared_path
    from tessera.streaming import trips as streams

    path = f"{_split_events(spark, 6)}/events.parquet"
    folder = shared_path(spark, "t-longest")
    both = lambda: (streams.trips_stream(spark, path, 1), streams.vendors_stream(spark, path, 1))
    cut = (streams.trips_with_vendor(*both()).writeStream.format("parquet").option("checkpointLocation", f"{folder}/join-checkpoint")
           .trigger(processingTime="0 seconds").start(f"{folder}/joined"))
    deadline = time.time() + 120
    while (cut.lastProgress is None or cut.lastProgress["batchId"] < 1) and time.time() < deadline:
        time.sleep(0.1)
    cut.stop()
    got = streams.update_longest_trips(*both(), folder)
    want = taxi.longest_trip_argmax(fx.trips(spark, SF_SMALL), fx.vendors(spark, SF_SMALL))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))


def test_longest_trips_of_an_empty_stream(spark):
    from tessera.session import shared_path
    from tessera.streaming import trips as streams

    path = shared_path(spark, "t-empty")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(0).write.parquet(path)
    empty = streams.update_longest_trips(streams.trips_stream(spark, path), streams.vendors_stream(spark, path), shared_path(spark, "t-l"))
    assert empty.count() == 0 and empty.columns == ["vendor_id", "trip_id", "distance", "duration"]
