import hashlib
import random
from collections import Counter

import pytest

from tessera.llm import substring_dedup as sd
from tests.llm.conftest import same


def brute(rows, w=35):
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(x[a : a + w]) for _, x in texts for a in range(len(x) - w + 1))
    out = []
    for i, x in texts:
        gone = set()
        for a in range(len(x) - w + 1):
            if seen[tuple(x[a : a + w])] > 1:
                gone |= set(range(a, a + w))
        kept = b" ".join(v for n, v in enumerate(x) if n not in gone)
        out.append((i, len(x), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_odd_rows(odd, empty):
    same(sd.digest(odd), brute([(r.doc_id, r.text) for r in odd.collect()]))
    assert sd.digest(empty).count() == 0


@pytest.mark.parametrize("seed,vocabulary", [(1, 10**6), (2, 3), (3, 40)])
def test_planted_passages(spark, seed, vocabulary):
    """Shared passages of many lengths at random places, over large, small and
    tiny vocabularies (periodic and self-repeating texts)."""
    rnd = random.Random(seed)

    def some(n):
        return [f"v{rnd.randrange(vocabulary)}" for _ in range(n)]

    shared = [some(rnd.choice([34, 35, 36, 60, 100])) for _ in range(8)]
    rows = []
    for i in range(60):
        words = some(rnd.randrange(0, 120))
        for _ in range(rnd.randrange(0, 3)):
            at = rnd.randrange(0, len(words) + 1)
            words[at:at] = rnd.choice(shared)
        rows.append((i, " ".join(words)))
    rows += [(100, "a b c " * 40), (101, "z " * 36), (102, "y " * 35), (103, "q r " * 18)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(sd.digest(docs), brute(rows))
