import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import topk_search as tk
from tests.llm.conftest import same


def brute(rows, k=5):
    ok = []
    for n, (i, v) in enumerate(rows):
        if i is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        ok.append((n, i, [math.floor(256 * c) for c in v]))
    out = []
    for n, i, q in ok:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, j, v in ok if m != n)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, uid string, b int")


@pytest.mark.parametrize("seed,spread", [(1, 1.0), (2, 0.01), (3, 30.0)])
def test_equals_brute_force(spark, monkeypatch, seed, spread):
    monkeypatch.setattr(tk, "BLOCK_ROWS", 150)
    monkeypatch.setattr(tk, "AT_ONCE", 4)
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(0, spread, 8)]) for i in range(600)]
    rows += [(1000 + i, list(rows[7][1])) for i in range(40)]  # ties
    same(tk.digest(table(spark, rows)), brute(rows))


def test_odd_rows(spark):
    rows = [
        (0, [0.1, 0.2]), (0, [0.1, 0.2]), (50, [1.0, -1.0, 2.0]), (None, [1.0, 1.0]), (3, None), (4, []), (5, [1.0, None]),
        (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [0.0, 0.0]), (9, [0.5]), (-50, [-0.004, 1e6]),
    ]
    same(tk.digest(table(spark, rows)), brute(rows))
    assert tk.digest(table(spark, rows[:1])).count() == 0
    assert tk.digest(table(spark, [])).count() == 0


def test_lengths_of_all_sizes(spark, monkeypatch):
    """A very long vector is dealt apart and widens no other block."""
    monkeypatch.setattr(tk, "BLOCK_CELLS", 1 << 10)
    rng = np.random.default_rng(9)
    rows = [(int(i), [float(x) for x in rng.normal(0, 1, int(rng.integers(1, 70)))]) for i in range(200)]
    rows += [(1000, [0.5] * 50_000), (1001, [-0.25] * 40_000)]
    same(tk.digest(table(spark, rows)), brute(rows))
    assert tk._blocks({1: 4097, 6: 17, 16: 3}) == {1: (0, 9), 6: (9, 2), 16: (11, 3)}


def test_vectors_are_shuffled_once(spark):
    """One exchange deals rows and queries, one merges; no cell has its own copy of a block."""
    rows = [(i, [float(i), 1.0]) for i in range(200)]
    plan = tk.digest(table(spark, rows))._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Exchange ") <= 2 and "Generate" in plan


def test_index_stops_before_the_last_level_and_is_exact():
    rng = np.random.default_rng(4)
    centre = rng.normal(0, 1, (5, 16))
    x = np.floor(256 * (centre[rng.integers(0, 5, 2000)] + rng.normal(0, 0.1, (2000, 16)))).astype(np.int64)
    index = tk.Index(x)
    query, vector, score = index.search(x[:10], np.arange(10), 5)
    assert len(vector) < 10 * 2000 / 4  # most vectors were proved out
    for q in range(10):
        exact = np.delete(x @ x[q], q)
        assert sorted(score[query == q], reverse=True)[:5] == sorted(exact, reverse=True)[:5]


def test_is_query_condition(spark):
    rows = [(i, [float(i), 1.0]) for i in range(10)]
    got = tk.search(table(spark, rows), F.col("vec_id") == 3, k=2).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(3, 1, 9), (3, 2, 8)]
