import hashlib
from collections import Counter

import pytest

from tessera.llm import line_dedup
from tests.llm.conftest import same

WS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(rows, min_docs):
    docs = [(i, (t or "").split("\n")) for i, t in rows]
    found = Counter(k for _, lines in docs for k in {key(x) for x in lines} if k)
    out = []
    for i, lines in docs:
        kept = [x for x in lines if found[key(x)] < min_docs or not key(x)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("min_docs,batches,fan_in", [(2, 4, 2), (3, 5, 3), (10, 1, 2)])
def test_equals_brute_force(odd, min_docs, batches, fan_in):
    got = line_dedup.drop_frequent_lines(odd, min_docs, batches=batches, fan_in=fan_in).select(
        "row.doc_id", "n_lines", "n_dropped", "kept")
    same(got, brute([(r.doc_id, r.text) for r in odd.collect()], min_docs))


def test_digest_and_empty(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    exp = [(i, n, d, hashlib.sha256(k.encode()).hexdigest()) for i, n, d, k in brute(rows, 10)]
    same(line_dedup.digest(odd), exp)
    assert line_dedup.digest(empty).count() == 0


def test_runs_are_compacted_and_settled_keys_stop(spark):
    runs = line_dedup.LineRuns(spark, min_docs=3, fan_in=2)
    for n in (2, 2, 5, 1):
        runs.add(spark.createDataFrame([(1, 1, n), (2 + n, 2, 1)], "h1 long, h2 long, n_docs long"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]  # four runs became one
    totals = {(r.h1, r.h2): r.n_docs for r in runs.totals().collect()}
    assert totals[1, 1] == 4  # reached 3 after two batches; later ones add nothing
    assert [tuple(r) for r in runs.frequent().collect()] == [(1, 1)]


def test_runs_outlive_the_call_and_the_tables(spark, odd, tmp_path):
    folder = str(tmp_path / "runs")
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    first, later = texts[::2], texts[1::2]
    docs = [spark.createDataFrame(rows, "doc_id long, text string") for rows in (first, later)]
    runs = line_dedup.add_documents(line_dedup.LineRuns(spark, 3, folder=folder), docs[0], batches=3)
    runs.save()
    for name in runs._tables.values():  # as in another session
        spark.sql(f"DROP TABLE {name}")
    again = line_dedup.LineRuns.load(spark, folder, 3)
    assert again.levels == runs.levels and again.buckets == runs.buckets
    line_dedup.add_documents(again, docs[1]).save()
    assert line_dedup.LineRuns.load(spark, folder, 3).version == 2
    whole = line_dedup.build_runs(docs[0].union(docs[1]), 3).frequent()
    assert again.frequent().count() > 0
    same(again.frequent(), whole.collect())


def test_merges_of_runs_neither_shuffle_nor_sort(spark):
    docs = spark.createDataFrame([(i, f"a{i}\nb{i % 7}\nc") for i in range(60)], "doc_id long, text string")
    runs = line_dedup.build_runs(docs, 3, batches=3)  # one run of level 0, one of level 1
    assert [len(x) for x in runs.levels] == [1, 1]
    spark.conf.set(line_dedup._SORTED, "true")
    try:
        plan = runs.totals()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(line_dedup._SORTED)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan


@pytest.mark.parametrize("fan_in", [2, 3, 4])
def test_levels_hold_all_counts(spark, fan_in):
    runs = line_dedup.LineRuns(spark, 10**6, fan_in)
    for n in range(5):
        runs.add(spark.createDataFrame([(1, -1, n + 1), (n, n, 2)], "h1 long, h2 long, n_docs long"))
    assert all(len(level) < fan_in for level in runs.levels)
    got = {(r.h1, r.h2): r.n_docs for r in runs.totals().collect()}
    assert got == {(1, -1): 15, **{(n, n): 2 for n in range(5)}}


def test_texts_of_very_many_frequent_lines(spark):
    """Work is linear in the lines of a text: this would otherwise take minutes."""
    common = [f"frequent line {i}" for i in range(24_000)]
    rows = [(d, "\n".join([f"own {d}", *common, "", *common[d:500], f"end {d}"])) for d in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = line_dedup.drop_frequent_lines(docs).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    assert sorted(map(tuple, got)) == [(d, 24_003 + 500 - d, 24_500 - d, f"own {d}\n\nend {d}") for d in range(10)]
