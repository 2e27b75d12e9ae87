import hashlib
import random
import zlib

import pytest

from tessera.llm import conversation_repair as cr
from tessera.llm import viterbi
from tests.llm.conftest import same

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        a, b = (" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        what = zlib.crc32(f"{a}:{b}".encode()) % 20
        if what == 1:
            text = ""
        if what == 2:
            text = "".join(c for c in text if c not in ".!?")
        if what == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    return out


def cheapest(rows, faults):
    """(cost, audit, repaired rows) by trying all edits, from the end."""
    goes = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    fits = {0: "user", 1: "user", 2: "assistant", 3: "user"}
    best = {0: (0, "", []), 3: (0, "", [])}

    def insert(best):
        best = dict(best)
        for _ in range(4):
            for s, role in fits.items():
                t = goes[role[0]][s]
                if t in best:
                    c, a, r = best[t]
                    new = (c + 2, "I" + a, [(role, "")] + r)
                    best[s] = min(best.get(s, new), new, key=lambda x: x[:2])
        return best

    best = insert(best)
    for (role, text), fault in list(zip(rows, faults))[::-1]:
        now = {}
        for s in range(4):
            c, a, r = best[s]
            options = [(c + 3, "D" + a, r)]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                c, a, r = best[goes[fits[s][0]][s]]
                options.append((c + 2 + extra, "R" + a, [(fits[s], text)] + r))
                t = goes.get(role[:1], {}).get(s)
                if t is not None:
                    c, a, r = best[t]
                    options.append((c + extra, "K" + a, [(role, text)] + r))
            now[s] = min(options, key=lambda x: x[:2])
        best = insert(now)
    return best[0]


def brute(rows, ids):
    by = {i: [] for i in ids}
    for conv, turn, role, text in rows:
        by[conv].append((turn, role, text))
    out = []
    for conv, part in by.items():
        part.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in part:
            body = text.strip(SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        turns = [t for t, _, _ in part if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in part]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, fixed = cheapest([(r, t) for _, r, t in part], faults)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha))
    return out


SCHEMA = "conv_id long, turn long, role string, text string, copy int, gone string, conv string, seq long"


def odd_rows(seed=1, n=900, convs=9):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "u", "sys"]
    texts = ["Hello.", "Hello", "ok!", "What?", "", " \n\t", None, "é…", "a.b", "x" * 30_000, "Why? ", "line\nline."]
    rows = []
    for i in range(n):
        conv = rng.choice([None, *range(convs), 3, 3, 3, 3])
        rows.append((conv, rng.choice([None, i // 5, i // 5, -i, i % 7]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"text {i}" + rng.choice(["", ".", "?"])))
    rows += [(77, t, ["user", "assistant"][t % 2], f"turn {t}.") for t in range(60)]
    rows += [(78, t, "assistant", f"turn {t}.") for t in range(31)] + [(79, 1, "tool", "") for _ in range(20)]
    rows += [(80, -(2**63), "user", "Q."), (80, 2**63 - 1, "assistant", "A."), rows[3], rows[4]]
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(gone, 0, "user", "lost")]


def want(rows):
    out = brute(brute_damage(rows), {r[0] for r in rows})
    return [(r[0], min(r[1], 2**63 - 1), *r[2:]) for r in out]


@pytest.mark.parametrize("most,partitions", [(3, 5), (1, 2), (256, 1), (16, 11)])
def test_equals_brute_force(spark, most, partitions):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 7, "g", "c", 1) for r in rows], SCHEMA).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same(cr.summary(cr.damaged(df), most), want(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_the_whole_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    got = cr.digest(table).collect()
    assert {r.conv_id for r in got} == {r[0] for r in rows}
    same(cr.digest(table), want(rows))


def test_repaired_rows_are_well_formed(spark):
    df = spark.createDataFrame([(*r, 7, "g", "c", 1) for r in odd_rows(3)], SCHEMA)
    got = cr.repair(cr.damaged(df), 8).orderBy("conv_id", "seq", "place").collect()
    roles = {}
    for r in got:
        roles.setdefault(r.conv_id, []).append(r.role[0])
    for conv in roles.values():
        body = "".join(conv).removeprefix("s")
        assert body and body == "ua" * (len(body) // 2)


def test_empty_table(spark):
    assert cr.digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_fix_up_equals_a_full_pass():
    rng = random.Random(9)
    for _ in range(300):
        symbols = "".join(rng.choice("xysuaoSUAO") for _ in range(rng.randint(0, 40)))
        first = viterbi.backward(symbols, viterbi.SPECULATIVE)
        assert viterbi.backward(symbols, viterbi.END, first) == viterbi.backward(symbols, viterbi.END)
        assert viterbi.unpacked(viterbi.packed(first)) == first
        # Differences stay small, so a byte holds each.
        assert max(max(v) for v in first) < 16
