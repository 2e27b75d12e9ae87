"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark.

Texts are normalised to words (A-Z lower-cased; everything in
``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` separates). Every distinct benchmark word
becomes one code point, so a 13-word window is a 13-character key, the
automaton has at most 13 nodes per window, and a document is one string that
is scanned once; matched word positions are mapped back to character offsets
of the original text.

The automaton holds at most ``SHARD_WORDS`` benchmark words: that is all the
driver and a task ever hold of the benchmark. One that fits is found in a single
pass with no shuffle. A larger one is read shard by shard (an item that is longer
than a shard is cut into pieces that overlap by a window less one word), one pass
over the documents for each; a pass writes the word runs and items of the texts
it hits, keyed by 128 bits of the text, and the runs of all passes are united.
Documents stay where they are in a pass; at the end ids meet hits by that key.

Defined results: null text has no words; an item without words has no window;
an item shorter than the window is one window of its own length; items with a
null id still hit words but are not listed; repeated items count once; an
empty benchmark hits nothing; empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import scratch, text_key
from tessera.llm._tokens import slices, texts_of

WINDOW = 13
SHARD_WORDS = 500_000
# Bytes that separate words, after lower-casing A-Z.
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_TABLE = bytearray(range(256))
for _b in _SEPARATORS:
    _TABLE[_b] = 0x20
for _b in range(ord("A"), ord("Z") + 1):
    _TABLE[_b] = _b + 32
_TABLE = bytes(_TABLE)
_FIRST_CHAR = 0xE000  # private-use area and beyond: no surrogates
_UNKNOWN = "\x00"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def _word_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in re.finditer(_WORD, text)]


class Automaton:
    """The word alphabet and the Aho-Corasick automaton of some items."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        import ahocorasick

        self.alphabet: dict[bytes, str] = {}
        owners: dict[str, set] = {}
        for item_id, text in items:
            ws = words(text)
            for w in ws:
                if w not in self.alphabet:
                    self.alphabet[w] = chr(_FIRST_CHAR + len(self.alphabet))
            coded = "".join(self.alphabet[w] for w in ws)
            for i in range(max(1, len(coded) - window + 1)) if coded else ():
                owners.setdefault(coded[i : i + window], set()).add(item_id)
        self.trie = ahocorasick.Automaton()
        for key, ids in owners.items():
            self.trie.add_word(key, (len(key), ids))
        if owners:
            self.trie.make_automaton()
        self.empty = not owners

    def find(self, ws: list[bytes]) -> Iterator[tuple[int, int, set]]:
        """(first word, end word, item ids) of each window occurrence."""
        if self.empty:
            return
        get = self.alphabet.get
        for end, (length, ids) in self.trie.iter("".join([get(w, _UNKNOWN) for w in ws])):
            yield end - length + 1, end + 1, ids


def unite(runs: list) -> list[list[int]]:
    """Word runs ``(first, end, ...)`` in order, those that touch made one; further
    fields are a start and an end that go with them."""
    out: list[list[int]] = []
    for run in sorted(runs):
        if out and run[0] <= out[-1][1]:
            if run[1] > out[-1][1]:
                out[-1][1::2] = run[1::2]
        else:
            out.append(list(run))
    return out


def scan(text: bytes | None, automaton: Automaton) -> tuple[int, int, list, list]:
    """(n_words, n_hit, item ids, word runs hit) of one text."""
    ws = words(text)
    found = list(automaton.find(ws))
    if not found:
        return len(ws), 0, [], []
    runs = unite([m[:2] for m in found])
    items = sorted({i for _, _, ids in found for i in ids if i is not None})
    return len(ws), sum(e - s for s, e in runs), items, runs


def contaminated(n_words: int, n_hit: int) -> bool:
    return n_hit > 0 and 20 * n_hit >= n_words


def _pieces(text: bytes, window: int) -> Iterator[tuple[bytes, int]]:
    """The text with its number of words, or overlapping pieces of it that hold
    at most ``SHARD_WORDS`` words (a window at least) and every window once."""
    ws, most = words(text), max(SHARD_WORDS, window)
    if len(ws) <= most:
        yield text, len(ws)
        return
    for at in range(0, len(ws) - window + 1, most - window + 1):
        piece = ws[at : at + most]
        yield b" ".join(piece), len(piece)


def load_items(
    benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW
) -> Iterator[list[tuple[str | None, bytes]]]:
    """Benchmark items in shards of at most ``SHARD_WORDS`` words, one in memory at a time."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("binary").alias("t")).where("t IS NOT NULL").distinct()
    shard, size = [], 0
    for row in scratch(rows, "dc-items").toLocalIterator():
        for piece, n in _pieces(bytes(row.t), window):
            if shard and size + n > SHARD_WORDS:
                yield shard
                shard, size = [], 0
            shard.append((row.i, piece))
            size += n
    yield shard


def _scanner(items, text: str, window: int, emit):
    def run(batches):
        automaton = Automaton(items, window)
        for batch in slices(batches, text):
            yield emit(batch, [(t, scan(t, automaton)) for t in texts_of(batch, text)])

    return run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RUNS = "array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>"
_RUN = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")]))


def _offsets(text: bytes, runs: list) -> list[tuple[int, int]]:
    """Code points ``[start, end)`` of word runs."""
    at = _word_spans(text.decode()) if runs else []
    return [(at[first][0], at[end - 1][1]) for first, end in runs]


def _shards(benchmark: DataFrame, window: int) -> tuple[list, Iterator | None]:
    """The only shard and None, or an empty list and all shards."""
    shards = load_items(benchmark, window=window)
    first = next(shards)
    second = next(shards, None)
    return (first, None) if second is None else ([], chain([first, second], shards))


def _hit_texts(docs: DataFrame, shards: Iterator, text: str, window: int) -> DataFrame:
    """k1, k2 (the key of a text), n_hit, items, contaminated and spans of the texts
    that any shard hits: one pass over the texts for each shard."""

    def emit(batch, scanned):
        hit = [i for i, (_, found) in enumerate(scanned) if found[1]]
        rows = batch.take(pa.array(hit, pa.int64()))
        runs = []
        for t, (_, _, _, words_hit) in (scanned[i] for i in hit):
            both = zip(words_hit, _offsets(t, words_hit))
            runs.append([{"first": f, "last": e, "start": a, "end": b} for (f, e), (a, b) in both])
        found = [scanned[i][1] for i in hit]
        return pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), pa.array([f[0] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.list_(pa.string())), pa.array(runs, _RUN)],
            names=["k1", "k2", "n_words", "items", "runs"],
        )

    def join_runs(batches):
        for batch in batches:
            runs = [unite([tuple(r.values()) for r in row]) for row in batch.column(4).to_pylist()]
            n_hit = [sum(r[1] - r[0] for r in row) for row in runs]
            bad = [contaminated(n, h) for n, h in zip(batch.column(2).to_pylist(), n_hit)]
            spans = [[{"start": r[2], "end": r[3]} for r in row] for row in runs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_hit, pa.int64()), batch.column(3), pa.array(bad, pa.bool_()), pa.array(spans, _SPANS)],
                names=["k1", "k2", "n_hit", "items", "contaminated", "spans"],
            )

    texts = docs.select(*text_key(F.col(text)), F.col(text).alias("text"))
    schema = f"k1 bigint, k2 bigint, n_words bigint, items array<string>, runs {_RUNS}"
    hits = None
    for items in shards:
        found = texts.mapInArrow(_scanner(items, "text", window, emit), schema)
        found = scratch(found.dropDuplicates(["k1", "k2"]), "dc-hits")
        hits = found if hits is None else hits.unionAll(found)
    # At most one row per text and shard.
    one = hits.groupBy("k1", "k2").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("runs")).alias("runs"),
    )
    return scratch(
        one.mapInArrow(join_runs, "k1 bigint, k2 bigint, n_hit bigint, items array<string>, contaminated boolean, spans array<struct<start:bigint,end:bigint>>"),
        "dc-texts",
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: id, n_words, n_hit, items (sorted strings), contaminated and
    spans (code-point ``[start, end)`` of each run of hit words)."""

    def emit(batch, scanned):
        spans = [[{"start": a, "end": b} for a, b in _offsets(t, found[3])] for t, found in scanned]
        counts = [s for _, s in scanned]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index(doc_id)),
                pa.array([s[0] for s in counts], pa.int64()),
                pa.array([s[1] for s in counts], pa.int64()),
                pa.array([s[2] for s in counts], pa.list_(pa.string())),
                pa.array([contaminated(s[0], s[1]) for s in counts], pa.bool_()),
                pa.array(spans, _SPANS),
            ],
            names=[doc_id, "n_words", "n_hit", "items", "contaminated", "spans"],
        )

    only, shards = _shards(benchmark, window)
    if shards is None:
        kind = docs.schema[doc_id].dataType.simpleString()
        schema = f"`{doc_id}` {kind}, n_words bigint, n_hit bigint, items array<string>, contaminated boolean, spans array<struct<start:bigint,end:bigint>>"
        return docs.select(doc_id, text).mapInArrow(_scanner(only, text, window, emit), schema)
    n_words = F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long")
    ids = docs.select(F.col(doc_id).alias("own_id"), n_words.alias("n_words"), *text_key(F.col(text)))
    found = ids.join(_hit_texts(docs, shards, text, window), ["k1", "k2"], "left")
    return found.select(
        F.col("own_id").alias(doc_id), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("contaminated", F.lit(False)).alias("contaminated"),
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, all columns untouched."""

    def emit(batch, scanned):
        return batch.filter(pa.array([not contaminated(s[0], s[1]) for _, s in scanned], pa.bool_()))

    only, shards = _shards(benchmark, window)
    if shards is None:
        return docs.mapInArrow(_scanner(only, text, window, emit), docs.schema)
    bad = _hit_texts(docs, shards, text, window).where("contaminated").select("k1", "k2")
    rows = docs.select(F.struct("*").alias("row"), *text_key(F.col(text)))
    return rows.join(bad, ["k1", "k2"], "left_anti").select("row.*")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find_contamination(docs, benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


# DuckDB form of digest(documents, benchmark).
DIGEST_SQL = r"""
WITH dw AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + 12], ' ') AS g
        FROM bw, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT rid, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
          FROM dw, sizes, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
occ AS (SELECT rid, n, i, item_id FROM grams JOIN win USING (n, g)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT rid, n, i FROM occ) o, unnest(range(i, i + n)) AS u(p) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM occ WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w)) AS contaminated
FROM dw LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""
