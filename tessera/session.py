"""Session construction and the shared scratch folder.

Scratch output (CSV inputs rendered from the test tables, Parquet written by
the conversion job, streaming checkpoints) always lives under the folder the
cluster names in ``spark.checkpoint.dir``, which every executor can reach.
Only when that setting is missing *and* the master is local do we create a
folder of our own, as tests do.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied by get_spark(); everything else stays at Spark's defaults.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Delete checkpoint files once nothing references them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tessera",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with AQE on and the session zone pinned to UTC.

    ``shuffle_partitions`` should follow the data: about 128-256 MiB of
    shuffle data per partition on a cluster, the core count in local tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``.

    Falls back to a fresh temporary folder only on a local master (tests);
    on a cluster a missing setting is an error, because a machine-local
    folder is not visible to other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not root:
        current = sc.getCheckpointDir()
        if current:
            root = current.rsplit("/", 1)[0]
        elif sc.master.startswith("local"):
            root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        else:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder shared "
                "by all executors (HDFS, S3, ...)"
            )
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


# Scratch folders and tables handed out per application, until released.
_handed_out: dict[str, set[str]] = {}
_tables: dict[str, set[str]] = {}


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/tessera/{label}-{uuid.uuid4().hex}"
    _handed_out.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def is_live(spark: SparkSession, path: str) -> bool:
    """Whether a scratch path has been handed out and not been released."""
    return path in _handed_out.get(spark.sparkContext.applicationId, ())


def own_table(spark: SparkSession, name: str) -> str:
    """Remember a catalog table, to be dropped by ``release``."""
    _tables.setdefault(spark.sparkContext.applicationId, set()).add(name)
    return name


def release(spark: SparkSession) -> int:
    """Drop this application's scratch tables and delete its scratch folders
    (those of ``shared_path``, nothing else); returns how many. Call it when
    the results read from them are no longer needed."""
    app = spark.sparkContext.applicationId
    for name in _tables.pop(app, ()):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    paths = _handed_out.pop(app, set())
    jvm = spark.sparkContext._jvm
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)
