import hashlib
import re

from tessera.llm import decontaminate as dc
from tests.llm.conftest import BASE, same

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, n=13):
    wins = {}
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - n + 1)) if w else ():
            wins.setdefault(tuple(w[a : a + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for size in {len(k) for k in wins}:
            for a in range(len(w) - size + 1):
                found = wins.get(tuple(w[a : a + size]))
                if found:
                    hit |= set(range(a, a + size))
                    ids |= {str(x) for x in found if x is not None}
        text = ",".join(sorted(ids))
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(text.encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


ITEMS = [(1, BASE), (2, "ONE"), (2, "one"), (10, "Line a, line B"), (None, "w0x0 w1x1 w2x2"), (4, None), (5, "..."), (6, "")]


def test_equals_brute_force(spark, odd):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    same(dc.digest(odd, bench), brute([(r.doc_id, r.text) for r in odd.collect()], ITEMS))


def test_shards_give_the_same(spark, odd, monkeypatch):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = dc.digest(odd, bench).collect()
    spans = dc.find_contamination(odd, bench).collect()
    kept = dc.drop_contaminated(odd, bench).collect()
    monkeypatch.setattr(dc, "SHARD_WORDS", 2)
    assert len(list(dc.load_items(bench))) > 2
    same(dc.digest(odd, bench), whole)
    same(dc.find_contamination(odd, bench), spans)
    same(dc.drop_contaminated(odd, bench), kept)


def test_runs_of_several_shards_are_united():
    assert dc.unite([(5, 9, 50, 90), (0, 3, 1, 30), (2, 5, 20, 51), (6, 8, 60, 80), (12, 13, 1, 2)]) == [
        [0, 9, 1, 90], [12, 13, 1, 2]]
    assert dc.unite([]) == []


def test_offsets_point_into_the_original(spark):
    text = "Xé -- " + BASE.replace(" ", "  ,").upper() + "! end"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, BASE)], "item_id long, text string")
    row = dc.find_contamination(docs, bench).first()
    (span,) = row.spans
    assert words(text[span.start : span.end]) == words(BASE)
    assert text[span.start :].startswith("WORD0") and row.contaminated


def test_empty_tables(spark, odd, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.digest(empty, none).count() == 0
    assert all(r.n_hit == 0 and not r.contaminated for r in dc.digest(odd, none).collect())
    assert dc.drop_contaminated(odd, none).columns == odd.columns
    same(dc.drop_contaminated(odd, none), odd.collect())


def test_a_long_item_is_cut_into_overlapping_pieces(spark, odd, monkeypatch):
    items = [*ITEMS, (7, " ".join(f"w{i % 977}x{i % 31}" for i in range(500)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = brute([(r.doc_id, r.text) for r in odd.collect()], items)
    for most in (1, 13, 14, 40, 200):
        monkeypatch.setattr(dc, "SHARD_WORDS", most)
        shards = list(dc.load_items(bench))
        assert all(sum(len(dc.words(t)) for _, t in s) <= max(most, 13) for s in shards if len(s) > 1)
        windows = {tuple(w[a : a + 13]) for s in shards for _, t in s for w in [dc.words(t)] for a in range(max(1, len(w) - 12)) if w}
        assert windows == {tuple(w[a : a + 13]) for _, t in items for w in [dc.words((t or "").encode())] for a in range(max(1, len(w) - 12)) if w}
        if most >= 40:
            same(dc.digest(odd, bench), whole)


def test_more_distinct_words_than_code_points():
    text = " ".join(f"q{i}" for i in range(1_120_000)).encode()
    pieces = list(dc._pieces(text, 13))
    assert max(n for _, n in pieces) <= dc.SHARD_WORDS < 0x10FFFF - dc._FIRST_CHAR
    windows = [w for t, n in pieces for w in range(int(t.split()[0][1:]), int(t.split()[0][1:]) + n - 12)]
    assert windows == list(range(1_120_000 - 12))
