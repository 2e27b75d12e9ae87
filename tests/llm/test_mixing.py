import pytest

from tessera.llm import mixing
from tests.llm.conftest import same


def water_fill(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while free:
        rate = (total - sum(target.values())) / sum(w[s] for s in free)
        over = [s for s in free if w[s] * rate >= cap * sizes[s]]
        if not over:
            target.update({s: w[s] * rate for s in free})
            break
        for s in over:
            target[s] = cap * sizes[s]
            free.discard(s)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 10, "c": 1000, None: 5}, {"a": 1}, {"a": 1, "b": 1000000}, {"a": 7, "b": 0, "c": 7},
    {"x": 10, "y": 10, "z": 10, "é": 1000},
])
def test_targets_equal_water_filling(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(water_fill(sizes))


def apportion(votes, caps, seats):
    """Sainte-Lague, one seat at a time."""
    got = [0] * len(votes)
    for _ in range(seats):
        free = [i for i in range(len(votes)) if got[i] < caps[i] and votes[i] > 0]
        if not free:
            break
        got[max(free, key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
    return got


def test_seats_are_those_of_the_highest_quotients(spark):
    import random

    rnd = random.Random(5)
    rows, exp = [], {}
    for shard in range(12):
        blocks = [rnd.randint(1, 60) for _ in range(rnd.randint(1, 7))]
        votes = [b * rnd.choice([0.0, 0.21, 0.5, 1.37, 2.9, 3.0]) for b in blocks]
        rows += [(shard, f"s{i}", b, v) for i, (b, v) in enumerate(zip(blocks, votes))]
        got = apportion(votes, [3 * b for b in blocks], int(sum(votes) + 0.5))
        exp.update({(shard, f"s{i}"): s for i, s in enumerate(got)})
    cells = spark.createDataFrame(rows, "shard long, source string, blocks long, votes double")
    assert {(r.shard, r.source): r.seats for r in mixing._apportion(cells, 3).collect()} == exp


def test_taken_follows_targets_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.digest(docs).collect()
    same(mixing.digest(docs.repartition(7)), rows)
    source = {r.doc_id: r.source for r in docs.collect()}
    taken, target = {}, {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] for s in target)


def test_many_sources_of_short_texts_meet_their_targets(spark):
    """Cells of a shard are far under one block of words here."""
    rows = [(i, "w " * (1 + i * 7 % 23), f"s{i % 150:03d}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, target = {}, {}
    for r in mixing.digest(docs).collect():
        assert 0 <= r.taken <= 3 * r["size"]
        s = rows[r.doc_id][2]
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
    assert len(target) == 150 and all(abs(taken[s] - target[s]) <= 2 for s in target)


def test_quotas_of_shards_are_differences_of_apportionments(spark):
    import random

    rnd = random.Random(8)
    targets = [(f"s{i}", rnd.choice([0.0, 63.9, 640.0, 1280.0, 3200.0, rnd.uniform(1, 9000)])) for i in range(25)] + [(None, 3200.0)]
    got = {}
    df = spark.createDataFrame(targets, "source string, target double")
    for r in mixing.block_quotas(df, 64, 40).collect():
        got.setdefault(r.shard, {})[r.source] = r.blocks
    live = sorted(((s, t) for s, t in targets if t > 0), key=lambda x: x[0] or "~")
    full, votes = [int(t // 64) for _, t in live], [t for _, t in live]
    shards, last = -(-sum(full) // 40), [0] * len(live)
    assert sorted(got) == list(range(1, shards + 1)) and shards > 10
    for i in range(1, shards + 1):
        seats = apportion(votes, full, min(40 * i, sum(full)))
        assert got[i] == {s: a - b for (s, _), a, b in zip(live, seats, last)}
        last = seats
    words = {r.source: r.words for r in mixing.source_words(df, 64, 40).collect()}
    assert all(abs(words[s] - t) <= 1 for s, t in targets) and abs(sum(words.values()) - sum(t for _, t in targets)) <= 1


def test_taken_equals_brute_force_over_words(spark):
    """Every word of a source's stream, block by block."""
    import hashlib
    import random

    rnd = random.Random(3)
    rows = [(i, "w " * rnd.choice([0, 1, 7, 64, 200, 900]), rnd.choice("aaaabc")) for i in range(400)] + [(9000, "w " * 5000, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.row.doc_id: r.taken for r in mixing.mix(docs, block=16, house=50).collect()}
    size = {i: len(t.split()) for i, t, _ in rows}
    total = {s: sum(size[i] for i, _, z in rows if z == s) for s in "abc"}
    words = {r.source: r.words for r in mixing.source_words(
        spark.createDataFrame(list(water_fill(total).items()), "source string, target double"), 16, 50).collect()}
    ord_of = {i: hashlib.md5(f"{mixing.SEED}|{i}|{t}".encode()).hexdigest() for i, t, _ in rows}
    n_decks = -(-len(rows) // mixing.DECK_DOCS)
    picks = {}
    for s in "abc":
        stream = sorted((i for i, _, z in rows if z == s), key=lambda i: (int(ord_of[i][:12], 16) % n_decks, ord_of[i]))
        owner = [i for i in stream for _ in range(size[i])]
        n, over = len(owner), words[s] % len(owner)
        chosen, rest = divmod(over, 16)
        usable = n // 16 - (rest > n % 16)
        edges = [-(-usable * j // chosen) for j in range(chosen + 1)] if chosen else []
        if chosen:
            df = spark.range(chosen).selectExpr(f"xxhash64('{mixing.SEED}', '={s}', id) h", "id").orderBy("id")
            picks[s] = [lo + r.h % (hi - lo) for r, lo, hi in zip(df.collect(), edges, edges[1:])]
        taken = dict.fromkeys(stream, 0)
        for i in owner:
            taken[i] += words[s] // n
        for b in picks.get(s, []):
            for i in owner[16 * b : 16 * b + 16]:
                taken[i] += 1
        for i in owner[16 * usable : 16 * usable + rest]:
            taken[i] += 1
        assert {i: got[i] for i in stream} == taken
        assert sum(taken.values()) == words[s]


def test_many_equal_quotients(spark):
    rows = [(0, f"s{i:03d}", 4, (7.5, 3.0, 1.5)[i % 3]) for i in range(90)]
    cells = spark.createDataFrame(rows, "shard long, source string, blocks long, votes double")
    got = {r.source: r.seats for r in mixing._apportion(cells, 3).collect()}
    assert [sorted(got.values()), sum(got.values())] == [sorted(apportion([r[3] for r in rows], [12] * 90, 360)), 360]


def test_odd_rows_and_empty(odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    assert rows[0].row.asDict().keys() == set(odd.columns)
    assert all(r.taken <= 3 * r["size"] for r in rows)
    blank = [r for r in rows if not (r.row.text or "").split()]
    assert blank and all(r["size"] == 0 and r.taken == 0 for r in blank)
    assert mixing.mix(empty).count() == 0
