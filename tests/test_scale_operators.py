"""Operators that must not depend on how rows and keys are spread."""

import os

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessera.operators import groups, joins, numbering, sampling, sets, small
from tessera.session import shared_path
from tessera.sources import readers
from tests.conftest import plan_text


@pytest.fixture
def plain_joins(spark):
    """No broadcasts by statistics, no adaptive execution, eight tasks."""
    new = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hot(spark, n, name):
    """A third of the rows have key 7, 5 % have none, the others one key each."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 20 == 1, None).otherwise(F.col("id") + 100)
    return spark.range(n).select(key.cast("long").alias("k"), F.col("id").alias(name))


def _per_task(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


@pytest.mark.parametrize("n_left,n_right", [(1800, 1500), (30_000, 900)])
def test_hot_key_on_both_sides_is_dealt_evenly(spark, plain_joins, n_left, n_right):
    left, right = _hot(spark, n_left, "x"), _hot(spark, n_right, "y")
    joined = joins.join_hot_keys(left, right, "k")
    tasks = _per_task(joined)
    assert len(tasks) == 8 and tasks[-1] <= 2 * tasks[4], tasks
    plain = left.join(right, "k")
    assert sum(tasks) == plain.count() and _per_task(plain)[-1] > 0.9 * sum(tasks)
    total = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("k", "x", "y").cast("decimal(38,0)"))).first()
    assert total(joined) == total(plain)


def test_hot_key_on_one_side(spark, plain_joins):
    left = _hot(spark, 60_000, "x")
    right = spark.range(60_200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    joined = joins.join_hot_keys(left, right, ["k"])
    tasks = _per_task(joined)
    assert tasks[-1] <= 2 * tasks[4], tasks
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, "k").collect()))


def test_hot_join_edge_cases(spark):
    schema = "k string, j int, v int"
    some = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), (None, 1, 3), ("b", None, 4), ("a", 2, 5)], schema)
    other = some.withColumnRenamed("v", "w")
    assert joins.join_hot_keys(some, other, ["k", "j"]).count() == 5
    assert joins.join_hot_keys(some.limit(0), other, ["k", "j"]).count() == 0
    assert joins.join_hot_keys(some, other.where("k IS NULL"), ["k", "j"]).columns == ["k", "j", "v", "w"]
    assert joins.heavy_keys(some.limit(0), ["k"], 8) == {}


@pytest.mark.parametrize("most", [small.BROADCAST_BYTES, 0])
def test_group_max_with_small_and_large_tables_of_groups(spark, plain_joins, monkeypatch, most):
    monkeypatch.setattr(small.side_table, "__defaults__", (most,))
    df = _hot(spark, 3000, "v").withColumn("v", F.when(F.col("k") == 100 + 5, None).otherwise(F.col("v")))
    out = groups.with_group_max(df, "k", "v", "m")
    text = out._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in text) == (most > 0) and ("hashpartitioning(k" in text or "hashpartitioning(coalesce" in text) == (most == 0)
    best = {}
    for k, v in df.collect():
        best[k] = max([x for x in (best.get(k), v) if x is not None], default=None)
    rows = out.collect()
    assert len(rows) == 3000 and all(r.m == best[r.k] for r in rows)


def _files(spark, contents):
    folder = shared_path(spark, "t-lines")
    os.makedirs(folder)
    for name, text in contents.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
    return folder


@pytest.mark.parametrize("split", ["64", "1000000"])
def test_lines_are_numbered_in_file_order(spark, plain_joins, split):
    rng = list(range(700))
    contents = {"b.txt": "".join(f"b{i} {'x' * (i * 37 % 90)}\n" for i in rng), "a.txt": "".join(f"a{i}\n" for i in rng[:40]),
                "c.txt": "", "d.txt": "last without end"}
    folder = _files(spark, contents)
    lines = [x for name in sorted(contents) for x in contents[name].splitlines()]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = readers.read_lines(spark, folder)
        out = numbering.number_in_input_order(df)
        assert df.rdd.getNumPartitions() > (20 if split == "64" else 0)
        assert [r.value for r in out.orderBy("row_idx").collect()] == lines
        assert sorted(r.row_idx for r in out.collect()) == list(range(len(lines)))
        some = numbering.number_in_input_order(df.where("length(value) % 2 = 0"))
        assert [r.value for r in some.orderBy("row_idx").collect()] == [x for x in lines if len(x) % 2 == 0]
        text = plan_text(out)
        assert "Exchange rangepartitioning" not in text and "Exchange hashpartitioning" not in text and "Sort" not in text
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_numbering_an_empty_input(spark):
    df = readers.read_lines(spark, _files(spark, {"a.txt": ""}))
    assert numbering.number_in_input_order(df).count() == 0


def test_vectors_are_compared_in_full(spark):
    a = Vectors.sparse(4, [1, 3], [0.5, 0.25])
    rows = [("l", a), ("l", a), ("l", Vectors.dense([0, 0.5, 0, 0.25])), ("l", Vectors.sparse(4, [0, 1, 3], [0.0, 0.5, 0.25])),
            ("m", a), ("l", Vectors.sparse(4, [1, 3], [0.5, 0.25 + 1e-9])), ("l", Vectors.sparse(5, [1, 3], [0.5, 0.25])),
            ("l", Vectors.dense([0.0, 0, 0, 0])), ("l", Vectors.sparse(4, [], [])), ("l", None), ("l", None)]
    df = spark.createDataFrame(rows, ["label_f", "features"])
    kept = sets.dedup_vectors(df.repartition(3), "features", ["label_f"])
    assert kept.columns == df.columns and kept.count() == 6


@pytest.mark.parametrize("fraction", [0.8, 0.0, 1.0, 0.333])
def test_split_is_exact_in_every_stratum(spark, plain_joins, fraction):
    label = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("s"), F.col("id") % 11))
    df = spark.range(4000).select(label.alias("l"), F.col("id").alias("key"))
    out = sampling.exact_split(df, "l", ["key"], fraction)
    rows = out.collect()
    assert len(rows) == 4000 and sorted(r.key for r in rows) == list(range(4000))
    sides = {}
    for r in rows:
        sides.setdefault(r.l, []).append(r.split == "train")
    assert all(sum(x) == int(fraction * len(x) + 0.5) for x in sides.values())
    again = sampling.exact_split(df.repartition(5, "key"), "l", ["key"], fraction).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, rows), key=repr)
    assert sampling.exact_split(df.limit(0), "l", ["key"]).count() == 0


def test_vector_duplicates_are_sorted_by_a_hash_first(spark):
    # Few labels: without the hash the sort compares whole vectors.
    rows = [("a" if i % 2 else "b", Vectors.dense([1.0, 2.0, i % 7 * 0.5])) for i in range(140)]
    kept = sets.dedup_vectors(spark.createDataFrame(rows, ["label_f", "features"]).repartition(3), "features", ["label_f"])
    assert kept.columns == ["label_f", "features"]
    got = sorted((r.label_f, tuple(r.features.toArray())) for r in kept.collect())
    assert got == sorted({(label, tuple(v.toArray())) for label, v in rows}) and len(got) == 14
    sorts = [x for x in kept._jdf.queryExecution().executedPlan().toString().splitlines() if "Sort [" in x]
    assert sorts and all("Sort [__hash" in x for x in sorts)
