import itertools
import random

import numpy as np
import pytest

from tessera.llm import near_dedup as nd
from tests.llm.conftest import same

LOW = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(t, k=5):
    w = (t or "").encode().translate(LOW).split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            root[find(b)] = find(a)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        c = (min(ids) if ids else None) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return out


def test_odd_rows_equal_brute_force(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    same(nd.digest(odd), brute(rows))
    assert nd.digest(empty).count() == 0 and nd.keep_one_of_each(empty).count() == 0


def test_chains_and_borderline_groups(spark):
    """Copies that drift step by step, and groups whose members are similar
    but mostly not linked."""
    rnd = random.Random(3)
    rows, n = [], 0
    for _ in range(6):
        w = [f"v{rnd.randint(0, 10**9)}" for _ in range(120)]
        for _ in range(25):
            w = list(w)
            for _ in range(rnd.choice([1, 2, 3, 4, 5])):
                w[rnd.randrange(len(w))] = f"v{rnd.randint(0, 10**9)}"
            rows.append((n, " ".join(w)))
            n += 1
        base = list(w)
        for _ in range(15):
            v = list(base)
            for _ in range(4):
                v[rnd.randrange(len(v))] = f"v{rnd.randint(0, 10**9)}"
            rows.append((n, " ".join(v)))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(nd.digest(docs), brute(rows))


def test_pipeline_form_keeps_one_of_each_and_all_columns(odd):
    got = nd.keep_one_of_each(odd)
    assert got.columns == odd.columns
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    exp = brute(rows)
    groups = {c for (_, t), (_, n, c, _) in zip(rows, exp) if n}
    kept = [r for r in got.collect() if shingles(r.text)]
    assert len(kept) == len(groups) and {r.doc_id for r in kept} <= {d for d, *_, k in exp if k}
    assert got.count() - len(kept) == sum(1 for _, n, *_ in exp if not n)


def test_unlinked_texts_with_null_or_repeated_ids_all_stay(spark):
    def words(k):
        return " ".join(f"u{k}x{i}" for i in range(40))

    rows = [(None, words(k)) for k in range(3)] + [(7, words(k)) for k in range(3, 6)]
    rows += [(None, words(0) + " tail"), (7, words(3)), (8, words(4) + " tail"), (9, words(6)), (None, words(6) + " tail")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in nd.keep_one_of_each(docs).collect()]
    assert len(got) == 7 and set(got) <= set(rows)
    assert sorted(t.split()[0] for _, t in got) == [f"u{k}x0" for k in range(7)]
    assert (9, words(6)) in got and {(7, words(k)) for k in (3, 4, 5)} <= set(got)


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(7)
    pool = np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64))
    for size, overlap in ((400, 300), (400, 360), (1500, 1000), (40, 30)):
        a, b = pool[:size], np.concatenate([pool[:overlap], pool[2000 : 2000 + size - overlap]])
        union = np.unique(np.concatenate([a, b]))
        sets = [np.sort(a), np.sort(b), union]
        at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        ka, kb, ku = nd.sketches(np.concatenate(sets), at)
        assert (np.maximum(ka, kb) == ku).all()
        truth = overlap / len(union)
        got = nd.estimate(ka[None], kb[None], np.array([float(len(a))]), np.array([float(len(b))]))[0]
        assert got == pytest.approx(truth, abs=0.15)
