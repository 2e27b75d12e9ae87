"""Q1 and Q2 as Structured Streaming queries.

The ``events`` table, one file or a folder of files, is read as a file stream.
Q1 is a streaming aggregation (24 groups of state) whose complete results are
written epoch by epoch. Q2 is two queries: a stream-stream join of trips and
vendor rows, whose state holds the key columns and two numbers of each row so that
a vendor row may come long after its trip, and a running arg-max with one trip
per vendor as state. Each trigger joins only rows that are new on either side.
A restarted query resumes from its checkpoint in the shared folder.
``availableNow`` processes what is there and stops, which makes a stream usable
as a batch job and in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.predicates import clean_trip
from tessera.functions.timecols import hour_of
from tessera.plans import taxi
from tessera.session import shared_path
from tessera.sources import fixtures as fx


def events_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The Parquet files of one table as a stream: ``path`` is the table's
    folder, or a single file. The schema comes from the footers of what is
    there (metadata only)."""
    path = path.rstrip("/")
    table = spark.read.parquet(path)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_batch)
    folder, _, name = path.rpartition("/")
    if [f.rpartition("/")[2] for f in table.inputFiles()] == [name]:
        # A file stream watches a folder; the filter is this one file's name.
        return stream.option("pathGlobFilter", name).parquet(folder)
    return stream.parquet(path)


def trips_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    cols = fx.trip_columns()
    return events_stream(spark, path, files_per_batch).select(*[c.alias(n) for n, c in cols.items()])


def hourly_avg_pickup_agg(trips: DataFrame) -> DataFrame:
    """Q1 as a streaming aggregation: 24 groups of state."""
    return (
        trips.where(clean_trip())
        .groupBy(hour_of("trip_start_time").alias("start_hour"))
        .agg(
            F.avg("trip_start_long").alias("avg_start_long"),
            F.avg("trip_start_lat").alias("avg_start_lat"),
        )
    )


def vendors_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return fx.vendor_rows(events_stream(spark, path, files_per_batch))


def trips_with_vendor(trips: DataFrame, vendors: DataFrame) -> DataFrame:
    """Clean trips joined with their vendor rows as both streams go on:
    (vendor_id, trip_id, distance, duration). Either side may come first, by
    any time, so nothing is ever forgotten: on a cluster set
    ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider,
    which keeps this state on disk."""
    metrics = trips.where(clean_trip()).select(
        "trip_id", taxi.distance("compat").alias("distance"), taxi.duration().alias("duration")
    )
    return metrics.join(vendors, "trip_id").select("vendor_id", "trip_id", "distance", "duration")


def longest_trip_agg(joined: DataFrame) -> DataFrame:
    """The longest trip per vendor so far (ties: longer duration, larger id),
    as a maximum of structs: the state is one trip per vendor, and a task sends
    one row per vendor."""
    best = F.max(F.struct("distance", "duration", "trip_id"))
    return (
        joined.where(F.col("distance").isNotNull())
        .groupBy("vendor_id")
        .agg(best.alias("best"))
        .select("vendor_id", "best.trip_id", "best.distance", "best.duration")
    )


def update_longest_trips(trips: DataFrame, vendors: DataFrame, folder: str) -> DataFrame:
    """Take in what is new in both streams and return the longest trip per
    vendor. ``folder`` (shared) holds both queries' checkpoints and results: the
    next call goes on from there, and a call that was cut off is resumed."""
    spark = trips.sparkSession
    joined = trips_with_vendor(trips, vendors)
    rows = run_append(joined, "stream-q2-join", f"{folder}/joined", f"{folder}/join-checkpoint")
    found = spark.readStream.schema(joined.schema).parquet(rows)
    agg = longest_trip_agg(found)
    out = f"{folder}/longest"
    spark.createDataFrame([], agg.schema).write.mode("ignore").parquet(f"{out}/epoch=-1")
    run_complete(agg, "stream-q2", out, f"{folder}/longest-checkpoint")
    return latest(spark, out)


def write_epoch(out: str):
    """A ``foreachBatch`` function that writes each complete result to a folder
    of its own, ``out/epoch=<n>``: earlier results stay readable while a new one
    is written, and replaying a batch after a restart rewrites its folder."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    return write


def latest(spark: SparkSession, out: str) -> DataFrame:
    """The result of the last finished epoch."""
    every = spark.read.parquet(out)
    return every.where(F.col("epoch") == every.agg(F.max("epoch")).scalar()).drop("epoch")


def run_complete(agg: DataFrame, label: str, out: str | None = None, checkpoint: str | None = None) -> str:
    """Run a complete-mode aggregation to the end of the available input
    (resuming from ``checkpoint`` if it holds an earlier run); return the
    folder to read with ``latest``."""
    spark = agg.sparkSession
    out = out or shared_path(spark, f"{label}-out")
    checkpoint = checkpoint or shared_path(spark, f"{label}-checkpoint")
    query = (
        agg.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_epoch(out))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return out


def run_append(rows: DataFrame, label: str, out: str | None = None, checkpoint: str | None = None) -> str:
    """Convert a stateless stream to Parquet (exactly once, by the file sink's
    log) to the end of the available input; return the folder."""
    spark = rows.sparkSession
    out = out or shared_path(spark, f"{label}-out")
    checkpoint = checkpoint or shared_path(spark, f"{label}-checkpoint")
    query = (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return out


def _events(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def hourly_avg_pickup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 over the event stream; same output as the batch query."""
    agg = hourly_avg_pickup_agg(trips_stream(spark, _events(sf_dir)))
    return latest(spark, run_complete(agg, "stream-q1")).orderBy("start_hour")


def longest_trip_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 (one longest clean trip per vendor) over streams of trips and vendors."""
    path = _events(sf_dir)
    best = update_longest_trips(trips_stream(spark, path), vendors_stream(spark, path), shared_path(spark, "stream-q2"))
    return best.orderBy("vendor_id")
