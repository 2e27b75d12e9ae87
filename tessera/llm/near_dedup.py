"""MinHash near-dedup with SetSketch registers.

1. Every text becomes its set of distinct word 5-shingles and a SetSketch of
   ``BANDS * ROWS`` registers. Each shingle is a Poisson process of
   exponentially spaced points dealt to random registers; a register keeps
   the smallest point of the set, truncated to ``floor(c - log_B x)`` in 16
   bits. Sketches of a union are the element-wise maximum.
2. Texts with the same shingle set form a class; all later work is on classes.
3. Classes that agree in the ``ROWS`` registers of a band share a bucket. A
   link of similarity 0.75 shares none of the 36 buckets with probability
   (1 - 0.75**4)**36 = 1e-6.
4. In each bucket all members are paired with its smallest class (a star, not
   all pairs). The maximum-likelihood estimate of the similarity, from the
   counts of larger, smaller and equal registers and the known set sizes,
   drops pairs below ``ESTIMATE`` (over five standard errors under 0.75); the
   others are verified on the full shingle sets.
5. Buckets whose members are still in several components are searched again.
   Their members are gathered into clusters (classes that such buckets
   connect), a cluster is dealt into blocks of ``BLOCK`` classes, and every pair
   of blocks is one task: pairs from different components whose sketches and
   estimate allow a link are verified there on the full sets, and only links
   that join two components are returned. So no pair that shares a bucket is
   left undecided, and no task or table holds a group's pairs.

Defined results: null or blank texts have size 0 and are linked with nothing;
texts under five words are one shingle, the whole sequence; repeated rows are
one class; a null id never becomes a component id unless the component has no
other; empty tables give empty results; extra columns are carried through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._common import ASCII_SPACE, scratch, text_key
from tessera.llm._tokens import grams, mix, slices, spans, texts_of, word_hashes
from tessera.llm.components import components

SHINGLE = 5
BANDS, ROWS = 36, 4
REGISTERS = BANDS * ROWS
BASE = 1.001
ESTIMATE = 0.55
BLOCK = 512
_LOW = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ELEMENTS = 1 << 18  # shingles sketched at once


def shingle_sets(texts: list[bytes | None], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and the texts' offsets."""
    words, at = word_hashes([t.translate(_LOW) if t else None for t in texts])
    n = np.diff(at)
    short = (n > 0) & (n < k)
    per_text = np.where(n >= k, n - k + 1, 0)
    owner = np.repeat(np.arange(len(texts)), per_text)
    first = np.concatenate([[0], np.cumsum(per_text)])[:-1]
    place = np.arange(len(owner)) - first[owner] + at[:-1][owner]
    every = grams(words, k)
    hashes = every[place] if len(place) else np.zeros(0, np.uint64)
    if short.any():
        hashes = np.concatenate([hashes, spans(words, at[:-1][short], at[1:][short])])
        owner = np.concatenate([owner, np.flatnonzero(short)])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(texts) + 1))


def _minima(hashes: np.ndarray, owner: np.ndarray, horizon: np.ndarray) -> np.ndarray:
    """Smallest point per (set, register), looking no further than horizon."""
    out = np.full((len(horizon), REGISTERS), np.inf)
    flat = out.reshape(-1)
    state, x, owner = hashes.copy(), np.zeros(len(hashes)), owner
    while len(state):
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        x = x - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / REGISTERS
        keep = x <= horizon[owner]
        state, x, owner = state[keep], x[keep], owner[keep]
        register = (mix(state ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(33)) % np.uint64(REGISTERS)
        np.minimum.at(flat, owner * REGISTERS + register.astype(np.int64), x)
    return out


def sketches(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(sets, REGISTERS) uint16 registers; zeros for empty sets."""
    n = np.diff(at)
    out = np.zeros((len(n), REGISTERS), np.uint16)
    todo, reach = np.flatnonzero(n), math.log(REGISTERS) + 5
    while len(todo):
        left = []
        cuts = np.searchsorted(np.cumsum(n[todo]), np.arange(1, n[todo].sum() // _ELEMENTS + 1) * _ELEMENTS)
        for part in np.split(todo, np.unique(cuts)):
            if not len(part):
                continue
            owner = np.repeat(np.arange(len(part)), n[part])
            shift = np.repeat(at[part] - np.concatenate([[0], np.cumsum(n[part])[:-1]]), n[part])
            low = _minima(hashes[np.arange(len(owner)) + shift], owner, reach / n[part])
            full = np.isfinite(low).all(axis=1)
            # exponentially spaced classes of the minima: 50 maps to 0
            value = np.floor((math.log(50.0) - np.log(low[full])) / math.log(BASE))
            out[part[full]] = np.clip(value, 0, 65535).astype(np.uint16)
            left.append(part[~full])
        todo, reach = np.concatenate(left), reach * 2
    return out


def band_hashes(registers: np.ndarray) -> np.ndarray:
    """(sets, BANDS) int64; equal for two sets where a band's registers agree."""
    grouped = registers.reshape(-1, BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), grouped.shape[:2]).copy()
    for r in range(ROWS):
        h = mix(h ^ (grouped[:, :, r] + np.uint64((r + 1) << 16)))
    return h.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of sketches with known sizes."""
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    equal = a.shape[1] - more - less
    u, v = (na / (na + nb))[:, None], (nb / (na + nb))[:, None]
    j = np.linspace(0.0, 1.0, 101)[None, :]

    def p(x):  # probability that a register is larger, for base BASE
        return np.clip(-np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / math.log(BASE), 1e-9, 1)

    up, down = p(u - v * j), p(v - u * j)
    same = np.clip(1 - up - down, 1e-9, 1)
    fit = more * np.log(up) + less * np.log(down) + equal * np.log(same)
    return j[0][fit.argmax(axis=1)]


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = texts_of(batch)
        hashes, at = shingle_sets(texts)
        owner = np.repeat(np.arange(len(texts)), np.diff(at))
        s1, s2 = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)
        np.add.at(s1, owner, mix(hashes))
        np.add.at(s2, owner, mix(hashes ^ np.uint64(0x5851F42D4C957F2D)))
        registers = sketches(hashes, at)
        yield pa.RecordBatch.from_arrays(
            [_column(batch, c) for c in ("doc_id", "k1", "k2")]
            + [
                pa.array(s1.view(np.int64)),
                pa.array(s2.view(np.int64)),
                pa.array(np.diff(at)),
                pa.array([r.tobytes() for r in registers], pa.binary()),
            ],
            names=["doc_id", "k1", "k2", "s1", "s2", "n", "sketch"],
        )


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "sketch"):
        raw = b"".join(_column(batch, "sketch").to_pylist())
        bands = band_hashes(np.frombuffer(raw, np.uint16).reshape(-1, REGISTERS))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bands.reshape(-1)), pa.array(np.repeat(_column(batch, "cid").to_numpy(), BANDS))], names=["bh", "cid"]
        )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        hashes, at = shingle_sets(texts_of(batch))
        sets = pa.LargeListArray.from_arrays(pa.array(at), pa.array(hashes.view(np.int64)))
        yield pa.RecordBatch.from_arrays([_column(batch, "cid"), sets.cast(pa.list_(pa.int64()))], names=["cid", "shingles"])


def _likely(a: pd.Series, b: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype="bool")
    x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(-1, REGISTERS) for s in (a, b))
    return pd.Series(estimate(x, y, na.to_numpy(float), nb.to_numpy(float)) >= ESTIMATE)


def _block_links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links between the two blocks of a cluster that join components."""
    _, i, j = key
    rows = rows.sort_values("cid", ignore_index=True)
    registers = np.frombuffer(b"".join(rows["sketch"]), np.uint16).reshape(-1, REGISTERS)
    cid, n, own = (rows[c].to_numpy() for c in ("cid", "n", "own"))
    root, sets = rows["root"].to_numpy().copy(), [np.sort(s) for s in rows["shingles"]]
    found = []
    for x in np.flatnonzero(own == i):
        other = (own == j) & (root != root[x]) & ((cid > cid[x]) | (i != j))
        ys = np.flatnonzero(other & (4 * np.minimum(n, n[x]) >= 3 * np.maximum(n, n[x])))
        # Few registers agree by far in most pairs; spare them the estimate.
        ys = ys[2 * (registers[ys] == registers[x]).sum(axis=1) >= REGISTERS]
        if not len(ys):
            continue
        e = estimate(np.broadcast_to(registers[x], (len(ys), REGISTERS)), registers[ys], np.full(len(ys), float(n[x])), n[ys].astype(float))
        for y in ys[e >= ESTIMATE]:
            if root[y] == root[x]:
                continue
            shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if 100 * shared >= 75 * (n[x] + n[y] - shared):
                found.append((min(cid[x], cid[y]), max(cid[x], cid[y])))
                root[root == root[y]] = root[x]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _likely_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow a link."""
    side = classes.select("cid", "n", "sketch")
    likely = F.pandas_udf(_likely, "boolean")
    return (
        pairs.join(side.toDF("a", "na", "sa"), "a")
        .join(side.toDF("b", "nb", "sb"), "b")
        .where(4 * F.least("na", "nb") >= 3 * F.greatest("na", "nb"))
        .where(likely("sa", "sb", "na", "nb"))
        .select("a", "b")
    )


def _full_sets(wanted: DataFrame, classes: DataFrame, keyed: DataFrame) -> DataFrame:
    """(cid, shingles) of the classes in ``wanted``, from one of their texts."""
    needed = classes.select("cid", "rep.k1", "rep.k2").join(wanted, "cid", "left_semi")
    return (
        keyed.join(needed, ["k1", "k2"])
        .select("cid", "text")
        .mapInArrow(_set_rows, "cid bigint, shingles array<bigint>")
        .groupBy("cid")
        .agg(F.first("shingles").alias("shingles"))
    )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among ``pairs``: similarity of the full sets at least 3/4."""
    shared = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(sets.toDF("b", "sb"), "b")
        .join(sets.toDF("a", "sa"), "a")
        .where(100 * shared >= 75 * (F.size("sa") + F.size("sb") - shared))
        .select("a", "b")
    )


def _remaining_links(members: DataFrame, roots: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that join components within buckets that hold several."""
    placed = members.join(roots, F.col("cid") == F.col("node"), "left").select(
        "bh", "cid", "head", F.coalesce("root", "cid").alias("root")
    )
    several = (
        placed.groupBy("bh").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bh")
    )
    still = scratch(placed.join(several, "bh", "left_semi"), "nd-open")
    cluster = components(still.select(F.col("head").alias("a"), F.col("cid").alias("b")))
    cluster = cluster.select(F.col("node").alias("cid"), F.col("root").alias("cluster"))
    sizes = cluster.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).where("size > 2")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = (
        cluster.join(sizes, "cluster")
        .withColumns({"blocks": blocks, "own": F.pmod(F.xxhash64("cid"), blocks).cast("int")})
        .join(still.select("cid", "root").distinct(), "cid")
        .join(classes.select("cid", "n", "sketch"), "cid")
        .join(sets, "cid")
        # A member meets every block; i <= j names a pair of blocks.
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid", "root", "n", "sketch", "shingles")
    )
    return rows.groupBy("cluster", "i", "j").applyInPandas(_block_links, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, k1, k2 (text key), n_shingles, component
    (null without words; ids may repeat or be null, this is the component's
    own), component_id, kept."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *text_key(F.col(text)))
    kind = keyed.schema["doc_id"].dataType.simpleString()
    rows = scratch(
        keyed.mapInArrow(_sketch_rows, f"doc_id {kind}, k1 bigint, k2 bigint, s1 bigint, s2 bigint, n bigint, sketch binary"),
        "nd-rows",
    )
    classes = scratch(
        rows.where("n > 0")
        .groupBy("s1", "s2")
        .agg(
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
            F.min("doc_id").alias("min_id"),
            F.min(F.struct("k1", "k2")).alias("rep"),
        )
        .withColumn("cid", F.monotonically_increasing_id()),
        "nd-classes",
    )
    bands = classes.select("cid", "sketch").mapInArrow(_band_rows, "bh bigint, cid bigint")
    heads = bands.groupBy("bh").agg(F.min("cid").alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = scratch(bands.join(heads, "bh").select("bh", "cid", "head", "size"), "nd-members")
    stars = members.where("cid <> head").select(F.col("head").alias("a"), F.col("cid").alias("b")).distinct()
    stars = scratch(stars, "nd-stars")
    wanted = stars.select("a").union(stars.select("b")).distinct().withColumnRenamed("a", "cid")
    sets = scratch(_full_sets(wanted, classes, keyed), "nd-sets")
    links = scratch(_verified(_likely_pairs(stars, classes), sets), "nd-links")
    roots = components(links)
    more = scratch(_remaining_links(members, roots, classes, sets), "nd-more")
    if more.take(1):
        roots = components(links.union(more))

    by_class = classes.join(roots, F.col("cid") == F.col("node"), "left").select(
        "s1", "s2", "min_id", F.coalesce("root", "cid").alias("root")
    )
    ids = by_class.groupBy("root").agg(F.min("min_id").alias("component_id"))
    by_class = by_class.join(ids, "root").select(
        F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.col("root").alias("component"), "component_id"
    )
    found = rows.drop("sketch").join(by_class, (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id", "k1", "k2", F.col("n").alias("n_shingles"), "component", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _row_key(doc_id) -> list:
    parts = [doc_id, doc_id.isNull(), F.col("k1"), F.col("k2")]
    return [F.xxhash64(*parts).alias("r1"), F.xxhash64(F.lit(1), *parts).alias("r2")]


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, all columns untouched; documents
    without words stay. Of rows that repeat both id and text one stays."""
    stay = (
        near_duplicates(docs, doc_id, text)
        .where("kept AND n_shingles > 0")
        .groupBy("component")
        .agg(F.min(F.struct("doc_id", "k1", "k2")).alias("s"))
        .select("s.*")
        .select(*_row_key(F.col("doc_id")))
    )
    blank = F.coalesce(F.btrim(F.col(text), F.lit(ASCII_SPACE)), F.lit("")) == ""
    rows = (
        docs.where(~blank)
        .select(F.struct(*docs.columns).alias("row"), *text_key(F.col(text)))
        .select("row", *_row_key(F.col("row").getField(doc_id)))
    )
    repeat = Window.partitionBy("r1", "r2").orderBy("r1")
    chosen = rows.join(stay, ["r1", "r2"]).withColumn("nth", F.row_number().over(repeat)).where("nth = 1")
    return docs.where(blank).union(chosen.select("row.*"))


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
