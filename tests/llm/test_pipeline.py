import pytest

import corpus_pipeline
from tessera.llm import decontaminate, line_dedup, mixing, near_dedup, quality
from tests.llm.conftest import same

SF = "/root/testdata/sf0.001"


def test_stages_are_the_operators(spark):
    """Each stage keeps what its operator decides, on all rows it gets."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "near dedup", "decontamination", "source mixing"]
    run = dict(corpus_pipeline.STAGES)

    out = run["quality classifier"](spark, docs, SF).cache()
    ok = {r.doc_id for r in quality.judged(docs, labels).collect() if r.accepted}
    assert {r.doc_id for r in out.collect()} == ok and out.columns == docs.columns

    cut = run["line dedup"](spark, out, SF).cache()
    exp = {r.row.doc_id: r.kept for r in line_dedup.drop_frequent_lines(out).collect()}
    assert {r.doc_id: r.text for r in cut.collect()} == exp and cut.schema == docs.schema

    one = run["near dedup"](spark, cut, SF).cache()
    assert {r.doc_id for r in one.collect()} == {r.doc_id for r in near_dedup.digest(cut).collect() if r.kept}

    clean = run["decontamination"](spark, one, SF).cache()
    bad = {r.doc_id for r in decontaminate.digest(one, bench).collect() if r.contaminated}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in one.collect()} - bad
    assert clean.columns == docs.columns

    mixed = run["source mixing"](spark, clean, SF)
    taken = {r.doc_id: r.taken for r in mixing.digest(clean).collect() if r.taken}
    assert {r.doc_id: r.taken for r in mixed.collect()} == taken


@pytest.mark.parametrize("rows", ["odd", "empty"])
def test_odd_documents_run_through(spark, request, rows):
    docs = request.getfixturevalue(rows)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.scratch(stage(spark, docs, SF), "t-pipeline")
        if name != "source mixing":
            assert docs.columns == request.getfixturevalue(rows).columns
    assert rows == "odd" or docs.count() == 0


def test_run_agrees_with_itself(spark):
    same(corpus_pipeline.run(spark, SF), corpus_pipeline.run(spark, SF).collect())
