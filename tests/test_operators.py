"""Splits, sampling, numbering, set operations; repeatability across
partitionings."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import numbering, sampling, sets


@pytest.fixture
def keyed(spark):
    rows = [(i, "abc"[i % 3], f"k{i % 97}") for i in range(3000)]
    return spark.createDataFrame(rows, "id long, label string, key string")


def test_hash_split_is_disjoint_complete_and_stratified(keyed):
    split = sampling.hash_split(keyed, ["id"], 0.8, seed=10)
    train = split.where("split = 'train'").select("id", "label")
    test = split.where("split = 'test'").select("id", "label")
    assert train.join(test, "id").count() == 0
    assert train.count() + test.count() == keyed.count()
    shares = {r.label: r.share for r in split.groupBy("label").agg(
        F.avg((F.col("split") == "train").cast("double")).alias("share")).collect()}
    assert all(0.75 < s < 0.85 for s in shares.values())


def test_hash_split_independent_of_partitioning(keyed):
    a = sampling.hash_split(keyed.repartition(1), ["id"]).where("split = 'train'")
    b = sampling.hash_split(keyed.repartition(13), ["id"]).where("split = 'train'")
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect())


def test_equal_rows_fall_on_one_side(keyed):
    split = sampling.hash_split(keyed, ["key"])
    sides = split.groupBy("key").agg(F.count_distinct("split").alias("n"))
    assert sides.where("n > 1").count() == 0


def test_stratified_sample_fractions(keyed):
    sample = sampling.stratified_sample(keyed, "label", {"a": 1.0, "b": 0.0, "c": 0.5}, seed=10)
    counts = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    assert counts["a"] == 1000 and "b" not in counts and 400 < counts["c"] < 600


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_number_rows_dense_in_order(keyed, parts):
    shuffled = keyed.select("id").orderBy(F.rand(1))
    out = numbering.number_rows(shuffled, ["id"], partitions=parts).collect()
    pairs = sorted((r.id, r.row_idx) for r in out)
    assert [p[1] for p in pairs] == list(range(3000))


def test_number_rows_spreads_a_hot_key(spark):
    # 60% of the rows share one order value; they must not all land in one
    # range partition, and the numbering stays dense.
    rows = [(0 if i % 5 < 3 else i, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k long, v long")
    out = numbering.number_rows(df, ["k"], partitions=8)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.5 * 5000
    assert sorted(r.row_idx for r in out.collect()) == list(range(5000))


def test_except_distinct_and_all(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,)], "x int")
    right = spark.createDataFrame([(1,), (3,)], "x int")
    assert sorted(r.x for r in sets.except_distinct(left, right).collect()) == [2]
    assert sorted(r.x for r in sets.except_all(left, right).collect()) == [1, 2]
    assert sets.dedup_rows(left).count() == 3
