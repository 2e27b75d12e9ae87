import hashlib
import string

import pytest
from pyspark.sql import functions as F

from tessera.llm import exact_dedup as ed
from tests.llm.conftest import same

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    """rows: (doc_id, text). kept is by count, as repeated rows are alike."""
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOW), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for n, i in enumerate(sorted(ids, key=lambda i: (i is not None, i), reverse=True)):
            out.append((i, keep, len(ids), n == 0, hashlib.sha256(t.encode()).hexdigest()))
    return out


EXTRA = [(100, "ONE"), (101, "Éa"), (102, "éa"), (103, "x" * 70 + "a"), (104, "X" * 70 + "A"), (105, "x" * 70 + "b"), (106, None)]


@pytest.mark.parametrize("head,bits", [(ed.HEAD, ed.BITS), (1, 1 << 16), (0, 1)])
def test_equals_brute_force(spark, odd, head, bits):
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(EXTRA, "doc_id long, text string")).repartition(3)
    got = ed.mark_copies(docs, head=head, bits=bits, hash_all=True).select("row.doc_id", "keep_id", "group_size", "kept", "sha256")
    same(got, brute([tuple(r) for r in docs.collect()]))


def test_only_survivors_are_read_in_full(spark, odd):
    rows = ed.mark_copies(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.sha256 is None for r in rows if r.row.text and r.row.text.startswith("line a\nline c"))
    assert all(r.sha256 for r in rows if r.group_size > 1)


def test_keeps_columns_and_one_row_of_each(spark, odd, empty):
    clash = odd
    for name in ("uid", "again", "key", "row", "bits", "bucket", "keep_id", "sha256"):
        clash = clash.withColumn(name, F.lit(1))
    kept = ed.drop_copies(clash)
    assert kept.columns == clash.columns
    texts = [(r.text or "").translate(LOW) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({(r.text or "").translate(LOW) for r in odd.collect()})
    assert ed.drop_copies(empty).count() == 0 and ed.digest(empty).count() == 0


def test_no_python_and_no_text_in_a_shuffle(spark, odd):
    plan = ed.digest(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "text" not in plan.split("Exchange", 1)[-1].replace("text_sha256", "")
