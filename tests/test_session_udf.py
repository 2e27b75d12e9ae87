"""Session helpers and the SQL-registered UDF forms."""

import pytest

from tessera.functions.geo import register_sql_functions
from tessera.session import checkpoint_root, shared_path


def test_shared_paths_live_under_the_checkpoint_folder(spark):
    root = checkpoint_root(spark)
    a, b = shared_path(spark, "x"), shared_path(spark, "x")
    assert a.startswith(root + "/tessera/x-") and a != b
    assert spark.sparkContext.getCheckpointDir()


def test_udf_registered_for_sql_matches_native(spark):
    register_sql_functions(spark)
    row = spark.sql(
        "SELECT haversine_km_udf(0.0D, 0.0D, 0.0D, 1.0D) AS u, haversine_compat_udf(0.0D, 0.0D, 0.0D, 1.0D) AS c"
    ).first()
    assert row.u == pytest.approx(111.19492664, abs=1e-6)
    assert row.c == pytest.approx(6371.0, abs=1e-6)


def test_spread_is_off_unless_asked_for(spark):
    from tessera.sources.tables import TEXT_PARTITIONS, spread

    one = spark.range(100).coalesce(1)
    assert spread(one, "id") is one
    spark.conf.set(TEXT_PARTITIONS, "6")
    try:
        dealt = spread(one, "id")
    finally:
        spark.conf.unset(TEXT_PARTITIONS)
    assert dealt.rdd.getNumPartitions() == 6
    assert sorted(r.id for r in dealt.collect()) == list(range(100))


def test_udf_needs_no_package_on_the_workers(tmp_path):
    """Python functions travel by value: a session started in another folder,
    whose workers cannot import the package, runs the UDF query."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from tessera.session import get_spark
spark = get_spark("local[2]", 2)
print("ROWS", entry.queries()["udf_haversine"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1000" in done.stdout, done.stderr[-2000:]


def test_release_deletes_scratch_folders_and_tables(spark):
    from tessera.session import is_live, own_table, release

    path = shared_path(spark, "gone")
    spark.range(3).write.parquet(path)
    name = own_table(spark, "tessera_release_test")
    spark.range(3).write.saveAsTable(name)
    assert is_live(spark, path)
    release(spark)
    assert not is_live(spark, path)
    assert not spark.catalog.tableExists(name)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
