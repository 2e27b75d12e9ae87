"""The stored classifier: same predictions in another session, no fit there."""

import json
import subprocess
import sys

import pytest

from tessera.plans import learn, model, text
from tessera.session import shared_path
from tessera.sources import fixtures as fx
from tests.conftest import ROOT, SF_SMALL

OTHER = """
import json, sys
from tessera.plans import learn, model
from tessera.session import get_spark
from tessera.sources import fixtures as fx
learn.train_mlp = model.fit = None  # nothing may be fitted here
spark = get_spark("local[2]", 2)
rows = model.score_stored(fx.complaints(spark, sys.argv[1]), sys.argv[2]).collect()
print("ROWS" + json.dumps(sorted([r.doc_id, r.label_f, r.split, r.prediction, r.predicted] for r in rows)))
"""


@pytest.fixture(scope="module")
def path(spark):
    return model.stored(spark, fx.complaints(spark, SF_SMALL), max_iter=30)


def test_another_session_predicts_the_same(spark, path):
    here = sorted([list(r) for r in model.score_stored(fx.complaints(spark, SF_SMALL), path)
                   .select("doc_id", "label_f", "split", "prediction", "predicted").collect()])
    out = subprocess.run([sys.executable, "-c", OTHER, SF_SMALL, path], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-2000:]
    there = json.loads(next(x for x in out.stdout.splitlines() if x.startswith("ROWS"))[4:])
    assert here == there
    assert {r[2] for r in here} == {"train", "test"}


def test_equals_the_fitting_session_and_covers_all_complaints(spark):
    complaints = fx.complaints(spark, SF_SMALL)
    fitted = model.fit(complaints, max_iter=20)
    loaded = model.load(model.save(fitted, shared_path(spark, "t-model")))
    a, b = (sorted(map(tuple, model.score(complaints, m).collect())) for m in (fitted, loaded))
    assert a == b and len(a) == text.tfidf_vectors(complaints).count()
    # The features are those of the fitting pipeline, entry by entry.
    want = {r.doc_id: (r.features_key, r.features) for r in text.tfidf_vectors(complaints).collect()}
    got = {r.doc_id: (r.features_key, r.features) for r in loaded.stages[0].transform(complaints).collect()}
    assert got == want


def test_new_labels_words_and_records(spark, path):
    lines = ["2015-03-10,xx,the la the der un", "2015-03-10,en,zzzz qqqq", "2009-03-10,en,the the", "2015-03-10,en,", "no record", None]
    new = spark.createDataFrame(list(enumerate(lines)), "doc_id long, line string")
    loaded = model.load(path)
    known = set(loaded.stages[0].getOrDefault("words"))
    rows = {r.doc_id: r for r in model.score(new, loaded).collect()}
    has = {i for i in (0, 1) if known & set(lines[i].split(",")[2].split())}
    assert set(rows) == has
    assert all(r.predicted in loaded.stages[3].getLabels() for r in rows.values())
    assert model.score(new.limit(0), loaded).count() == 0


def test_scores_a_stream(spark, path):
    folder = shared_path(spark, "t-new-complaints")
    fx.complaints(spark, SF_SMALL).repartition(3).write.parquet(folder)
    loaded, out = model.load(path), shared_path(spark, "t-scored")
    stream = spark.readStream.schema("doc_id long, line string").option("maxFilesPerTrigger", 1).parquet(folder)
    query = (model.score(stream, loaded).writeStream.format("parquet").option("checkpointLocation", shared_path(spark, "t-ck"))
             .trigger(availableNow=True).start(out))
    query.awaitTermination()
    batch = model.score(fx.complaints(spark, SF_SMALL), loaded)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, batch.collect()))


def test_nothing_to_fit_on(spark):
    none = spark.createDataFrame([(1, "2009-01-01,a,b")], "doc_id long, line string")
    with pytest.raises(ValueError):
        model.fit(none)
    assert text.tfidf_vectors(none).count() == 0 and text.idf(none).count() == 0 and text.term_frequency(none).count() == 0
    assert learn.dataset(text.tfidf_vectors(none)).labels == []


def test_lookup_costs_no_shuffle_of_documents(spark):
    plan = text.term_frequency(fx.complaints(spark, SF_SMALL), 5000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "array_contains" not in plan and "array_remove" not in plan


def test_texts_are_read_once_to_score_and_twice_to_fit(spark, path, monkeypatch):
    scored = model.score_stored(fx.complaints(spark, SF_SMALL), path)
    assert scored.columns == ["doc_id", "label_f", "prediction", "predicted", "split"]
    assert scored._jdf.queryExecution().executedPlan().toString().count("documents.parquet") == 1
    # The sides and the predictions are those of the complaints by themselves.
    alone = {r.doc_id: (r.label_f, r.prediction, r.predicted) for r in model.score(fx.complaints(spark, SF_SMALL), model.load(path)).collect()}
    sides = {r.doc_id: r.split for r in model.fit_split(fx.complaints(spark, SF_SMALL)).collect()}
    rows = scored.collect()
    assert len(rows) == len(alone)
    assert {r.doc_id: (r.label_f, r.prediction, r.predicted) for r in rows} == alone
    assert all(r.split == sides[r.doc_id] for r in rows)
    passes = []
    for name in ("fit_lexicon", "count_vectors"):
        real = getattr(text, name)
        monkeypatch.setattr(text, name, lambda *a, f=real, n=name: passes.append(n) or f(*a))
    model.fit(fx.complaints(spark, SF_SMALL), max_iter=1)
    assert passes == ["fit_lexicon", "count_vectors"]


def test_counts_of_the_fit_give_the_transformed_features(spark):
    complaints = fx.complaints(spark, SF_SMALL)
    features, counts = model.Lexicon().fit_counts(complaints)
    alone = model.Lexicon().fit(complaints)
    assert features.weights == alone.weights
    a, b = ({r.doc_id: r for r in df.collect()} for df in (features.weigh(counts), alone.transform(complaints)))
    assert a == b and a
