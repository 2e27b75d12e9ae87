"""Conversation structure repair: rank-convergence parallel Viterbi.

Rows are dealt by range over (conversation, turn, ...), so that a conversation
of any size lies in order over as many partitions as it needs. Each partition
cuts its runs into chunks of at most ``CHUNK`` rows and ``CHUNK_CHARS`` characters
(one longer text is a chunk of its own), with one symbol per row (``viterbi``).
A conversation that surely lies within one chunk is repaired there and then.

For the others every chunk works backward from the cost vector at its end: the
last chunk's is known, the others start from a speculative one. Fix-up passes
hand a chunk the vector that its successor has at its start. Where that differs
by more than a constant from the one used, the chunk reruns from its end until
its stored vectors differ only by a constant from the new ones; the passes end
when no chunk has to. Mostly two suffice. Rows that must go do not change a
vector and rows without a usable role hardly do, so vectors may travel through
chunks of nothing else: there are at most as many passes as such a
conversation has chunks.

Vectors that are right up to a constant decide every choice of the trace. Each
chunk traces the least audit from every state it might be entered in; the
states at the chunks' starts come from composing these maps, in doubling steps.
Then the chunks are repaired independently of each other. Whole conversations
are never held together, but the hash of a conversation's text is by its nature
a serial pass over its chunks (``digest``), one chunk at a time.

Duplicates are found within a chunk, and over the chunks of a conversation by
an aggregate of 128-bit hashes of role and text.

Defined results: a null in a column counts as one space; rows without a
conversation id are one conversation with a null id; equal turns are ordered by
role, then by the MD5 of the text, then as they are read; a role is kept only
if it starts with s, u or a and fits, so an empty or unknown one is reroled or
deleted; gaps beyond a long saturate; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import viterbi
from tessera.llm._common import ASCII_SPACE, scratch

CHUNK = 256
CHUNK_CHARS = 4 << 20
OUT_CHARS = 4 << 20  # a task hands on its chunks when they hold this much
#: Pairs of initials that may follow each other.
LEGAL = {"su", "ua", "au"}
ENDS = ".!?"

_ROWS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_CHUNK_FIELDS = [
    ("conv_id", pa.int64()), ("part", pa.int32()), ("chunk", pa.int32()), ("whole", pa.bool_()),
    ("symbols", pa.string()), ("keys", pa.list_(pa.binary())), ("rows", _ROWS),
    ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
    ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()),
    ("cost", pa.int64()), ("audit", pa.string()),
]
_CHUNK_SCHEMA = (
    "conv_id bigint, part int, chunk int, whole boolean, symbols string, keys array<binary>, "
    "rows array<struct<role:string,text:string>>, illegal bigint, first string, last string, "
    "first_turn bigint, last_turn bigint, turns bigint, cost bigint, audit string"
)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone of the rows after damage; rows that are
    dropped stay as ``gone``, so that no conversation is lost."""

    def shown(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    what = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        shown("role").alias("role"), shown("text").alias("text"), what.alias("what"),
    ).select(
        "conv_id", "turn",
        F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        (F.col("what") == 0).alias("gone"),
        F.explode(F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def _symbol(role: str, fault: str) -> str:
    if fault in "xy":
        return fault
    initial = role[:1] if role[:1] in viterbi.KEPT else "o"
    return initial.upper() if fault == "t" else initial


class _Run:
    """The rows of a conversation that a partition holds, as chunks."""

    def __init__(self, conv_id, most: int):
        self.conv_id, self.most, self.done = conv_id, most, 0
        self._new()

    def _new(self):
        self.roles, self.texts, self.turns, self.keys, self.symbols, self.seen, self.chars = [], [], [], [], [], set(), 0

    def full(self, text: str) -> bool:
        return bool(self.roles) and (len(self.roles) >= self.most or self.chars + len(text) > CHUNK_CHARS)

    def add(self, turn, role: str, text: str) -> None:
        key, body = None, text.rstrip(ASCII_SPACE)
        if not body:
            fault = "x"
        else:
            key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
            if key in self.seen:
                key, fault = None, "y"
            else:
                self.seen.add(key)
                fault = "-" if body[-1] in ENDS else "t"
        self.roles.append(role)
        self.texts.append(text)
        self.turns.append(turn)
        self.keys.append(key)
        self.symbols.append(_symbol(role, fault))
        self.chars += len(text)

    def chunk(self, part: int, whole: bool) -> tuple:
        """The chunk's row; a whole conversation is repaired."""
        symbols, roles = "".join(self.symbols), self.roles
        initials = [r[:1] for r in roles]
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        turns = [t for t in self.turns if t is not None]
        rows, keys, cost, audit = list(zip(roles, self.texts)), self.keys, None, None
        if whole:
            vectors = viterbi.backward(symbols, viterbi.END)
            audit, _, cost = viterbi.trace(symbols, vectors, viterbi.START, True)
            rows, keys = viterbi.edited(audit, roles, self.texts, viterbi.START), None
        out = (
            self.conv_id, part, self.done, whole, symbols, keys, [{"role": r, "text": t} for r, t in rows],
            illegal, initials[0] if initials else None, initials[-1] if initials else None,
            turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), cost, audit,
        )
        self.done += 1
        self._new()
        return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, _CHUNK_FIELDS)], names=[n for n, _ in _CHUNK_FIELDS])


def _chunker(most: int):
    """Sorted rows -> chunks. Only a run that has others of its partition on
    both sides is surely a whole conversation."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        current, first, out, size = None, True, [], 0
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for lo in range(0, batch.num_rows, 512):  # Python strings of a few rows at a time
                for conv_id, turn, role, text, gone in zip(*[c.slice(lo, 512).to_pylist() for c in columns]):
                    if current is None or conv_id != current.conv_id:
                        if current is not None:
                            out.append(current.chunk(part, not first and not current.done))
                            first = False
                        current = _Run(conv_id, most)
                    if gone:
                        continue
                    if current.full(text):
                        out.append(current.chunk(part, False))
                    current.add(turn, role, text)
                    size += len(text)
                    if size > OUT_CHARS and out:
                        yield _batch(out)
                        out, size = [], 0
        if current is not None:
            out.append(current.chunk(part, False))
        if out:
            yield _batch(out)

    return run


def _chunks(rows: DataFrame, most: int) -> DataFrame:
    order = ["conv_id", "turn", "role", "mark", "uid", "copy"]
    keyed = rows.withColumn("mark", F.md5("text")).withColumn("uid", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return scratch(dealt.select("conv_id", "turn", "role", "text", "gone").mapInArrow(_chunker(most), _CHUNK_SCHEMA), "cr-chunks")


def _conv():
    """The conversation as a string that is never null."""
    return F.when(F.col("conv_id").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("conv_id").cast("string")))


def _numbered(chunks: DataFrame) -> DataFrame:
    """conv, part, chunk, seq (position in the conversation) and final (its last
    chunk). The windows hold a row per partition that a conversation lies in."""
    parts = chunks.groupBy("conv", "part").agg((F.max("chunk") + 1).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    all_parts = Window.partitionBy("conv")
    offsets = parts.select(
        F.col("conv").alias("o_conv"), F.col("part").alias("o_part"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(all_parts).alias("total"),
    )
    return (
        chunks.join(offsets, (F.col("conv") == F.col("o_conv")) & (F.col("part") == F.col("o_part")))
        .withColumn("seq", F.col("offset") + F.col("chunk"))
        .withColumn("final", F.col("seq") == F.col("total") - 1)
        .drop("o_conv", "o_part", "offset", "total")
    )


def _repeats(numbered: DataFrame) -> DataFrame:
    """conv, seq and the places of rows that an earlier chunk has already; a
    chunk tells a key once, so a key of all rows comes once per chunk."""
    rows = numbered.select("conv", "seq", F.posexplode("keys").alias("i", "key")).where("key IS NOT NULL")
    firsts = (
        rows.groupBy(F.col("conv").alias("f_conv"), F.col("key").alias("f_key"))
        .agg(F.min("seq").alias("f_seq"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    later = rows.join(firsts, (F.col("conv") == F.col("f_conv")) & (F.col("key") == F.col("f_key"))).where("seq > f_seq")
    return later.groupBy(F.col("conv").alias("r_conv"), F.col("seq").alias("r_seq")).agg(F.collect_list("i").alias("again"))


_STATE = "conv string, part int, chunk int, seq bigint, final boolean, symbols string, vectors binary, head binary, tail binary"


def _state_batch(batch, symbols: list[str], vectors: list[list]) -> pa.RecordBatch:
    data = [viterbi.packed(v) for v in vectors]
    return pa.RecordBatch.from_arrays(
        [batch.column(i) for i in range(5)]
        + [pa.array(symbols, pa.string()), pa.array(data, pa.binary()), pa.array([d[:4] for d in data], pa.binary()), pa.array([d[-4:] for d in data], pa.binary())],
        names=["conv", "part", "chunk", "seq", "final", "symbols", "vectors", "head", "tail"],
    )


def _speculate(batches):
    """conv, part, chunk, seq, final, symbols, again -> first vectors."""
    for batch in batches:
        symbols, vectors = [], []
        for s, again, final in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist(), batch.column(4).to_pylist()):
            marked = list(s)
            for i in again or ():
                marked[i] = "y"
            symbols.append("".join(marked))
            vectors.append(viterbi.backward(symbols[-1], viterbi.END if final else viterbi.SPECULATIVE))
        yield _state_batch(batch, symbols, vectors)


def _fix_up(batches):
    """The state with the vector wanted at the end (null: as it is) -> renewed."""
    for batch in batches:
        symbols, vectors = batch.column(5).to_pylist(), []
        for s, data, want in zip(symbols, batch.column(6).to_pylist(), batch.column(9).to_pylist()):
            stored = viterbi.unpacked(data)
            vectors.append(viterbi.backward(s, tuple(want), stored) if want else stored)
        yield _state_batch(batch, symbols, vectors)


def _solved(numbered: DataFrame) -> DataFrame:
    """Vectors of all chunks that are right up to a constant."""
    repeats = _repeats(numbered)
    marked = numbered.select("conv", "part", "chunk", "seq", "final", "symbols").join(
        repeats, (F.col("conv") == F.col("r_conv")) & (F.col("seq") == F.col("r_seq")), "left"
    )
    state = scratch(
        marked.select("conv", "part", "chunk", "seq", "final", "symbols", "again").mapInArrow(_speculate, _STATE), "cr-state"
    )
    while True:
        heads = state.select(F.col("conv").alias("n_conv"), (F.col("seq") - 1).alias("n_seq"), F.col("head").alias("want"))
        joined = state.join(heads, (F.col("conv") == F.col("n_conv")) & (F.col("seq") == F.col("n_seq")), "left")
        wrong = F.col("want").isNotNull() & (F.col("want") != F.col("tail"))
        if not joined.where(wrong).take(1):
            return state
        state = scratch(
            joined.select(*state.columns, F.when(wrong, F.col("want")).alias("want")).mapInArrow(_fix_up, _STATE), "cr-state"
        )


def _exits(batches):
    """The state after a chunk for each of the four before it, as digits."""
    for batch in batches:
        maps = []
        for s, data, final in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            vectors = viterbi.unpacked(data)
            maps.append("".join(str(viterbi.trace(s, vectors, at, final)[1]) for at in range(4)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.string())], names=["conv", "seq", "map"])


def _entries(state: DataFrame) -> DataFrame:
    """e_conv, e_seq, entry: the state in which each chunk but the first is
    entered. Maps are composed over 1, 2, 4, ... chunks."""
    maps = scratch(
        state.select("conv", "seq", "symbols", "vectors", "final").mapInArrow(_exits, "conv string, seq bigint, map string"), "cr-maps"
    )
    longest, reach = maps.agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0], 1
    while reach <= longest:
        earlier = maps.select(F.col("conv").alias("b_conv"), (F.col("seq") + reach).alias("b_seq"), F.col("map").alias("b_map"))
        # Entry k of the later map replaces the digit k of the earlier one.
        through = F.expr("translate(b_map, '0123', map)")
        maps = scratch(
            maps.join(earlier, (F.col("conv") == F.col("b_conv")) & (F.col("seq") == F.col("b_seq")), "left").select(
                "conv", "seq", F.when(F.col("b_map").isNull(), F.col("map")).otherwise(through).alias("map")
            ),
            "cr-maps",
        )
        reach *= 2
    return maps.select(
        F.col("conv").alias("e_conv"), (F.col("seq") + 1).alias("e_seq"), F.substring("map", viterbi.START + 1, 1).cast("int").alias("entry")
    )


def _repair_chunks(batches):
    """symbols, tail, final, entry, rows and the rest -> repaired chunks."""
    for batch in batches:
        get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for at in range(batch.num_rows):
            symbols, tail, final, entry, rows = (get[n][at].as_py() for n in ("symbols", "tail", "final", "entry", "rows"))
            state = viterbi.START if entry is None else entry
            audit, _, cost = viterbi.trace(symbols, viterbi.backward(symbols, tuple(tail)), state, final)
            fixed = viterbi.edited(audit, [r["role"] for r in rows], [r["text"] for r in rows], state)
            one = batch.slice(at, 1).select(["conv_id", "seq", "symbols", "illegal", "first", "last", "first_turn", "last_turn", "turns"])
            new = [pa.array([cost], pa.int64()), pa.array([audit], pa.string()), pa.array([[{"role": r, "text": t} for r, t in fixed]], _ROWS)]
            yield pa.RecordBatch.from_arrays([*one.columns, *new], names=[*one.schema.names, "cost", "audit", "rows"])


_REPAIRED = (
    "conv_id bigint, seq bigint, symbols string, illegal bigint, first string, last string, first_turn bigint, "
    "last_turn bigint, turns bigint, cost bigint, audit string, rows array<struct<role:string,text:string>>"
)


def repaired_chunks(rows: DataFrame, most: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """The repaired chunks of conversations that are one chunk, and of the others.

    rows: conv_id, turn, role, text, gone (true: only names the conversation),
    copy (order of rows alike). A chunk has its conversation, its place there
    (seq), symbols, audit, cost and repaired rows.
    """
    chunks = _chunks(rows, most)
    whole = chunks.where("whole").select(
        "conv_id", F.lit(0).cast("long").alias("seq"), "symbols", "illegal", "first", "last",
        "first_turn", "last_turn", "turns", "cost", "audit", "rows",
    )
    parts = chunks.where("NOT whole").withColumn("conv", _conv())
    numbered = _numbered(parts.select("conv", "part", "chunk", "symbols", "keys"))
    state = _solved(scratch(numbered, "cr-numbered"))
    entries = _entries(state)
    plan = scratch(
        state.join(entries, (F.col("conv") == F.col("e_conv")) & (F.col("seq") == F.col("e_seq")), "left").select(
            F.col("conv").alias("s_conv"), F.col("part").alias("s_part"), F.col("chunk").alias("s_chunk"),
            "seq", "final", F.col("symbols").alias("marked"), "tail", "entry",
        ),
        "cr-plan",
    )
    same = (F.col("conv") == F.col("s_conv")) & (F.col("part") == F.col("s_part")) & (F.col("chunk") == F.col("s_chunk"))
    split = parts.join(plan, same).select(
        "conv_id", "seq", F.col("marked").alias("symbols"), "illegal", "first", "last", "first_turn", "last_turn", "turns",
        "tail", "final", "entry", "rows",
    )
    return whole, split.mapInArrow(_repair_chunks, _REPAIRED)


def repair(rows: DataFrame, most: int = CHUNK) -> DataFrame:
    """conv_id, seq, place, role, text: the repaired rows, in order of seq and place."""
    whole, split = repaired_chunks(rows, most)
    return whole.unionByName(split).select("conv_id", "seq", F.posexplode("rows").alias("place", "row")).select(
        "conv_id", "seq", "place", "row.role", "row.text"
    )


_RESULT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_LONG = (1 << 63) - 1


def _count(symbols: str) -> tuple[int, int, int]:
    return symbols.count("x"), symbols.count("y"), sum(c.isupper() for c in symbols)


def _joined(batches):
    """Chunks of whole conversations in order -> one row per conversation."""
    names = [f.split()[0] for f in _RESULT.split(", ")]
    kinds = [pa.string() if n in ("audit", "repaired_sha256") else pa.int64() for n in names]
    conv, begun, total = None, False, None

    def result():
        low, high = total["low"], total["high"]
        gaps = 0 if low is None else max(-_LONG, min(_LONG, high - low + 1 - total["turns"]))
        values = [conv, gaps, *total["faults"], total["illegal"], total["cost"], "".join(total["audit"]), total["hash"].hexdigest()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    for batch in batches:
        for lo in range(batch.num_rows):
            r = batch.slice(lo, 1).to_pylist()[0]
            if not begun or r["conv_id"] != conv:
                if begun:
                    yield result()
                conv, begun = r["conv_id"], True
                total = {"low": None, "high": None, "turns": 0, "faults": [0, 0, 0], "illegal": 0, "cost": 0, "audit": [],
                         "hash": hashlib.sha256(), "last": None, "any": False}
            total["faults"] = [a + b for a, b in zip(total["faults"], _count(r["symbols"]))]
            total["illegal"] += r["illegal"]
            if r["first"] is not None:
                if total["last"] is not None:
                    total["illegal"] += total["last"] + r["first"] not in LEGAL
                total["last"] = r["last"]
            if r["first_turn"] is not None:
                total["turns"] += r["turns"] - (total["high"] == r["first_turn"])
                total["low"] = r["first_turn"] if total["low"] is None else total["low"]
                total["high"] = r["last_turn"]
            total["cost"] += r["cost"]
            total["audit"].append(r["audit"])
            for row in r["rows"]:
                total["hash"].update(("\n" * total["any"] + row["role"] + ":" + row["text"]).encode())
                total["any"] = True
    if begun:
        yield result()


def summary(rows: DataFrame, most: int = CHUNK) -> DataFrame:
    """One row per conversation: gaps, faults, cost, audit and the hash of the repaired text."""
    whole, split = repaired_chunks(rows, most)
    body = F.array_join(F.transform("rows", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    # The span of two longs may need one bit more than a long has.
    span = F.col("last_turn").cast("decimal(20,0)") - F.col("first_turn").cast("decimal(20,0)") + 1 - F.col("turns")
    limit = F.lit(_LONG).cast("decimal(20,0)")

    def times(letters: str):
        return (F.char_length("symbols") - F.char_length(F.translate("symbols", letters, ""))).cast("long")

    at_once = whole.select(
        "conv_id", F.when(F.col("turns") == 0, F.lit(0).cast("long")).otherwise(F.least(span, limit).cast("long")).alias("gaps"), times("x").alias("blank"),
        times("y").alias("duplicate"), times("SUAO").alias("truncated"), "illegal", "cost", "audit", F.sha2(body, 256).alias("repaired_sha256"),
    )
    in_order = split.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return at_once.union(in_order.mapInArrow(_joined, _RESULT))


def digest(conversations: DataFrame) -> DataFrame:
    return summary(damaged(conversations))
