import numpy as np
from pyspark.sql import functions as F

from tessera.llm import quality
from tests.llm.conftest import same

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    """Fit on about half of the labels (some 2000), judge the other half."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    half = F.xxhash64("doc_id") % 2 == 0
    model = quality.train(docs, labels.where(half))
    got = quality.score(docs, model).join(labels.where(~half), "doc_id").select("accepted", "quality", "toxic").collect()
    clean = [r.accepted for r in got if r.quality == 1 and r.toxic == 0]
    junk = [not r.accepted for r in got if r.quality == 0]
    toxic = [not r.accepted for r in got if r.toxic == 1]
    assert sum(clean) >= 0.95 * len(clean)
    # Measured with these 2000 labels: junk 95 %, toxic 82 %; rare insults need
    # the 6000 labels that the operator takes where there are as many.
    assert sum(junk) >= 0.9 * len(junk) and sum(toxic) >= 0.75 * len(toxic)


def test_held_out_accuracy_at_four_fifths(spark):
    """Fit on four fifths of the labels, at production parameters."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64(F.lit("holdout"), "doc_id"), F.lit(5)) == 0
    marked = docs.join(labels.where(held), "doc_id", "left_semi")
    got = quality.score(marked, quality.train(docs, labels.where(~held))).join(labels, "doc_id").collect()
    clean = [r.accepted for r in got if r.quality == 1 and r.toxic == 0]
    junk = [not r.accepted for r in got if r.quality == 0]
    toxic = [not r.accepted for r in got if r.toxic == 1]
    # Measured: 0.997, 0.991, 0.970.
    assert min(len(clean), len(junk), len(toxic)) > 50
    assert np.mean(clean) >= 0.98 and np.mean(junk) >= 0.95 and np.mean(toxic) >= 0.9


def test_fits_are_repeatable_and_score_odd_rows(spark, odd):
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0), int(i == 4)) for i in range(15)] + [(None, 1, 0), (3, None, 1), (5, 0, 0)],
        "doc_id long, quality int, toxic int")
    a = quality.judged(odd, labels)
    assert a.count() == odd.count()
    same(quality.judged(odd.repartition(5), labels), a.collect())


def test_without_labels_everything_is_accepted(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.accepted for r in quality.judged(odd, none).collect())
    assert quality.judged(empty, none).count() == 0
    kept = quality.keep_accepted(odd, quality.train(odd, none))
    assert kept.columns == odd.columns
    same(kept, odd.collect())


def test_columns_that_clash_with_internal_names(spark, odd):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(15)], "doc_id long, quality int, toxic int")
    clash = odd
    for name in ("ord", "good", "l_id", "d_id", "meta_0", "test", "t", "m", "quality"):
        clash = clash.withColumn(name, F.lit("x"))
    same(quality.judged(clash, labels), quality.judged(odd, labels).collect())
    assert quality.keep_accepted(clash, quality.train(clash, labels)).columns == clash.columns


def test_every_feature_is_found():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**64, 5000, np.uint64))
    keys = np.concatenate([keys, keys[:50] + np.uint64(1)])  # close neighbours too
    keys = np.unique(keys)
    view = quality.View(keys[::-1], np.arange(len(keys), dtype=float))
    ids, owner = view.ids(np.concatenate([keys, keys ^ np.uint64(1 << 40)]), np.repeat([0, 1], len(keys)))
    assert (np.sort(ids[owner == 0]) == np.arange(len(keys))).all() and not len(ids[owner == 1])
    assert not len(quality.View(keys[:0], np.zeros(0)).ids(keys, np.zeros(len(keys), int))[0])
    one = quality.View(keys[:1], np.ones(1))
    assert one.ids(keys, np.arange(len(keys)))[1].tolist() == [0]
