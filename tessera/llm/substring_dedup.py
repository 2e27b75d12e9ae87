"""Substring dedup: De Bruijn compaction of repeated word windows.

A window of ``WINDOW`` words is an edge of the De Bruijn graph of the corpus; a
text is a walk. Windows are grouped by their *minimiser*, the smallest hash
among the ``ANCHOR``-word grams inside: equal windows have equal minimisers, and
the stretch of consecutive windows of a text that share one is a nonbranching
path of up to a few dozen edges (a super-k-mer). All joins are on hashes:

1. Count minimiser positions. A window can only repeat if its minimiser does,
   so paths whose minimiser is unique in the corpus go (most do), by semi-join.
2. Compact: paths with equal content (128-bit hash) are one path; if it occurs
   twice, all its windows are repeated.
3. Branch points: a path that occurs once, but shares its minimiser with
   others, is opened into single edges, as is one source occurrence of each
   repeated path that shares a minimiser with such a path. Edges that occur
   twice are repeated.
4. Verify at the source coordinates: the words of every occurrence of a
   repeated path are read again and their MD5 compared within the path.
5. Glue: per text, repeated paths and edges merge into maximal spans.

A passage that everything shares costs one row per task in each count (partial
aggregates) and its join partitions are split by AQE. Texts are recognised by
a 128-bit key of their content, so ids may be null or repeated.

Defined results: null or blank text has no words; texts shorter than the
window keep all words; copies and repeated rows repeat each other; windows are
judged on the input, also within one text; empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import scratch, text_key
from tessera.llm._tokens import grams, slices, spans, texts_of, word_hashes

WINDOW = 35
ANCHOR = 12
_SECOND = 0xC2B2AE3D27D4EB4F  # odd multiplier of the second hash
OPEN, SOURCE, PATH = 0, 1, 2


def _sliding(f, x: np.ndarray, n: int) -> np.ndarray:
    """f (minimum or maximum) over every ``n`` neighbours, by doubling."""
    if len(x) < n:
        return x[:0]
    width, y = 1, x
    while 2 * width <= n:
        y = f(y[:-width], y[width:])
        width *= 2
    return f(y[: len(y) - (n - width)], y[n - width :])


def _minimisers(h: np.ndarray, at: np.ndarray, window: int, anchor: int):
    """(grams, minimiser of each window, whether the window fits its text)."""
    g = grams(h, anchor)
    m = _sliding(np.minimum, g, window - anchor + 1)
    end = np.repeat(at[1:], np.diff(at))[: len(m)]
    return g, m, np.arange(len(m)) + window <= end


def anchor_counts(texts: list, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """Minimisers of the texts and at how many positions each one serves."""
    h, at = word_hashes(texts)
    g, m, fits = _minimisers(h, at, window, anchor)
    side = np.zeros(window - anchor, np.uint64)
    # The largest minimiser among the windows over a gram; a gram serves as a
    # minimiser if and only if it equals that.
    top = _sliding(np.maximum, np.concatenate([side, np.where(fits, m, 0).astype(np.uint64), side]), window - anchor + 1)
    return np.unique(g[: len(top)][g[: len(top)] == top], return_counts=True)


def paths(texts: list, window: int = WINDOW, anchor: int = ANCHOR):
    """(text number, first window within the text, windows, minimiser, c1, c2)
    of every super-k-mer."""
    h, at = word_hashes(texts)
    _, m, fits = _minimisers(h, at, window, anchor)
    new = fits.copy()
    new[1:] &= ~((m[1:] == m[:-1]) & fits[:-1])
    start = np.flatnonzero(new)
    total = np.concatenate([[0], np.cumsum(fits)])
    length = total[np.append(start[1:], len(m))] - total[start]
    owner = np.searchsorted(at, start, "right") - 1
    end = start + length + window - 1
    return owner, start - at[owner], length, m[start], spans(h, start, end), spans(h, start, end, _SECOND)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchor_rows(window: int, anchor: int):
    def run(batches):
        for batch in slices(batches):
            v, n = anchor_counts(texts_of(batch), window, anchor)
            yield pa.RecordBatch.from_arrays([_signed(v), pa.array(n.astype(np.int64))], names=["v", "n"])

    return run


def _path_rows(window: int, anchor: int):
    def run(batches):
        for batch in slices(batches):
            owner, start, length, v, c1, c2 = paths(texts_of(batch), window, anchor)
            keys = [batch.column(batch.schema.get_field_index(k)).take(pa.array(owner)) for k in ("k1", "k2")]
            yield pa.RecordBatch.from_arrays(
                keys + [pa.array(start), pa.array(length), _signed(v), _signed(c1), _signed(c2)],
                names=["k1", "k2", "start", "length", "v", "c1", "c2"],
            )

    return run


def _edge_rows(window: int):
    """Single edges of opened paths, and a check of the words of the others."""

    def one(text: bytes, todo: list[dict]):
        (h, _), words = word_hashes([text]), text.split()
        w1, w2 = grams(h, window), grams(h, window, _SECOND)
        whole = [t for t in todo if t["kind"] == PATH]
        if whole:
            s = np.array([t["start"] for t in whole])
            e = s + np.array([t["length"] for t in whole]) + window - 1
            check = [hashlib.md5(b" ".join(words[a:b])).digest()[:8] for a, b in zip(s, e)]
            yield PATH, spans(h, s, e), spans(h, s, e, _SECOND), s, np.frombuffer(b"".join(check), np.int64)
        for kind in (OPEN, SOURCE):
            runs = [np.arange(t["start"], t["start"] + t["length"]) for t in todo if t["kind"] == kind]
            if runs:
                p = np.concatenate(runs)
                yield kind, w1[p], w2[p], p, np.zeros(len(p), np.int64)

    def run(batches):
        for batch in slices(batches):
            todo = batch.column(batch.schema.get_field_index("todo")).to_pylist()
            keys = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in ("k1", "k2")]
            out = [(i, *x) for i, (t, jobs) in enumerate(zip(texts_of(batch), todo)) for x in one(t, jobs)]
            if not out:
                continue
            sizes = [len(x[2]) for x in out]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([x[1] for x in out], sizes), pa.int32()),
                    _signed(np.concatenate([x[2] for x in out])),
                    _signed(np.concatenate([x[3] for x in out])),
                    pa.array(np.repeat([keys[0][x[0]] for x in out], sizes), pa.int64()),
                    pa.array(np.repeat([keys[1][x[0]] for x in out], sizes), pa.int64()),
                    pa.array(np.concatenate([x[4] for x in out]), pa.int64()),
                    pa.array(np.concatenate([x[5] for x in out]), pa.int64()),
                ],
                names=["kind", "h1", "h2", "k1", "k2", "start", "seen"],
            )

    return run


def repeated_spans(docs: DataFrame, text: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(k1, k2, spans): for each text with a repeated window, its windows'
    word positions as unordered stretches (start, length in windows)."""
    keyed = docs.select(*text_key(F.col(text)), F.col(text).alias("text")).where("text IS NOT NULL")
    places = (
        keyed.mapInArrow(_anchor_rows(window, anchor), "v bigint, n bigint")
        .groupBy("v")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
        .select("v")
    )
    every = keyed.mapInArrow(
        _path_rows(window, anchor), "k1 bigint, k2 bigint, start bigint, length bigint, v bigint, c1 bigint, c2 bigint"
    )
    shared = scratch(every.join(places, "v", "left_semi"), "sd-paths")

    classes = shared.groupBy("c1", "c2").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("k1", "k2", "start", "length")).alias("source"),
        F.first("v").alias("v"),
    )
    classes = scratch(classes, "sd-classes")
    branching = classes.where("n = 1").select("v").distinct()
    sources = classes.where("n > 1").join(branching, "v", "left_semi").select("source.*", F.lit(SOURCE).alias("kind"))
    placed = shared.join(classes.select("c1", "c2", "n"), ["c1", "c2"]).select(
        "k1", "k2", "start", "length", F.when(F.col("n") > 1, PATH).otherwise(OPEN).alias("kind")
    )
    todo = placed.unionByName(sources).groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "length", "kind")).alias("todo"))
    edges = scratch(
        keyed.join(todo, ["k1", "k2"]).mapInArrow(
            _edge_rows(window), "kind int, h1 bigint, h2 bigint, k1 bigint, k2 bigint, start bigint, seen bigint"
        ),
        "sd-edges",
    )
    repeated = (
        edges.where(F.col("kind") != PATH)
        .groupBy("h1", "h2")
        .agg(F.sum(F.when(F.col("kind") == SOURCE, 2).otherwise(1)).alias("n"))
        .where("n > 1")
        .select("h1", "h2")
    )
    single = edges.where(F.col("kind") == OPEN).join(repeated, ["h1", "h2"], "left_semi")
    # Occurrences of a path whose words differ somewhere would have shared a
    # 128-bit hash by accident; they are not repeats.
    unequal = (
        edges.where(F.col("kind") == PATH)
        .groupBy("h1", "h2")
        .agg(F.min("seen").alias("lo"), F.max("seen").alias("hi"))
        .where("lo <> hi")
        .select(F.col("h1").alias("c1"), F.col("h2").alias("c2"))
    )
    whole = shared.join(classes.where("n > 1").select("c1", "c2"), ["c1", "c2"], "left_semi").join(
        unequal, ["c1", "c2"], "left_anti"
    )
    marks = single.select("k1", "k2", "start", F.lit(1).cast("long").alias("length")).unionByName(
        whole.select("k1", "k2", "start", "length")
    )
    return scratch(marks.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "length")).alias("spans")), "sd-spans")


def _cut(doc_id: str, window: int):
    def kept(text: bytes | None, stretches: list | None) -> tuple[int, int, bytes]:
        words = text.split() if text else []
        if not stretches:
            return len(words), 0, b" ".join(words)
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, [s["start"] for s in stretches], 1)
        np.add.at(edge, [s["start"] + s["length"] + window - 1 for s in stretches], -1)
        stay = np.cumsum(edge)[:-1] == 0
        left = [w for w, k in zip(words, stay.tolist()) if k]
        return len(words), len(words) - len(left), b" ".join(left)

    def run(batches):
        for batch in slices(batches):
            marked = batch.column(batch.schema.get_field_index("spans")).to_pylist()
            out = [kept(t, s) for t, s in zip(texts_of(batch), marked)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index(doc_id)),
                    pa.array([x[0] for x in out], pa.int64()),
                    pa.array([x[1] for x in out], pa.int64()),
                    pa.array([x[2] for x in out], pa.binary()).cast(pa.string()),
                ],
                names=[doc_id, "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per document: id, n_words, n_removed and ``kept``, the words outside
    every repeated window joined by one space."""
    marks = repeated_spans(docs, text, window, anchor)
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id), F.col(text).alias("text"), *text_key(F.col(text)))
    return (
        rows.join(marks, ["k1", "k2"], "left")
        .select(doc_id, "text", "spans")
        .mapInArrow(_cut(doc_id, window), f"`{doc_id}` {kind}, n_words bigint, n_removed bigint, kept string")
    )


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# DuckDB form of digest(documents).
DIGEST_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT rid, i, md5(array_to_string(w[i : i + 34], ' ')) AS g
        FROM d, unnest(range(1, len(w) - 33)) AS t(i) WHERE len(w) >= 35),
rep AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, i + o AS p FROM win JOIN rep USING (g), range(0, 35) AS r(o)),
x AS (SELECT rid, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS u(p)),
kept AS (SELECT x.rid, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE gone.p IS NULL) AS kept
         FROM x LEFT JOIN gone USING (rid, p) GROUP BY x.rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
