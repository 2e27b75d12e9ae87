"""Exact top-k search: an impact-ordered index, processed score at a time.

Vectors are integers, floor(256 * x). In a block of vectors each dimension d
has two posting lists: one of the impacts x - lo (for queries with a positive
weight there) and one of hi - x (negative weight); lo and hi are the block's
extremes, so impacts are never negative and a score is a constant plus the sum
of |weight| * impact. Impacts are quantised to ``BANDS`` levels; a posting segment
holds the vectors of one list and one level.

Segments are processed by descending level, all lists of a level for all queries
of a group, adding |weight| * (least impact of the segment) to the accumulators.
After each level the unseen rest of a vector is bounded by the sum of |weight| *
(largest impact still to come), a seen posting errs by less than a level. A
vector whose upper bound is under the k-th best lower bound is proved out. The
levels stop only when few enough vectors are left; those possible members are
scored exactly, in integers. There is no approximation.

Vectors are dealt by length to blocks of at most about ``BLOCK_ROWS`` vectors and
``BLOCK_CELLS`` components. Each vector is shuffled once, to its block, whose index is
built once; the queries are shuffled to every block (queries times blocks, as the
work is) and stream past the index, some at a time, so a task holds one block
and one batch of queries. A block returns at most k rows per query, which are
merged by a window per query.

Defined results: vectors that are null, empty or hold a null or non-finite
component, and rows without an id, take no part; a query never finds its own
row, but a repeated row with the same id is another row; vectors of different
length are compared over zeros where the shorter one ends; ties go to the
smaller id; with fewer candidates than k all are returned; empty tables give
empty results; other columns are not read.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._common import scratch

K = 5
BANDS = 64
BLOCK_ROWS = 4096
BLOCK_CELLS = 1 << 22
AT_ONCE = 128  # queries that share an accumulator table
QUERY_CELLS = 1 << 20  # components of the queries handled at once
FEW = 64  # stop when on average this many vectors per query are possible


class Index:
    """The impact-ordered posting segments of one block."""

    def __init__(self, x: np.ndarray, bands: int = BANDS):
        """x: (vectors, dimensions) int64."""
        self.x, self.bands = x, bands
        self.lo, self.hi = x.min(axis=0), x.max(axis=0)
        self.steps = (self.hi - self.lo) // bands + 1

    @cached_property
    def lists(self) -> list:
        out, bands = [], self.bands
        for impacts in (self.x - self.lo, self.hi - self.x):
            levels = impacts // self.steps
            order = np.argsort(-levels, axis=0, kind="stable").astype(np.int32)
            cuts = [np.searchsorted(-levels[order[:, d], d], -np.arange(bands, -1, -1)).astype(np.int32) for d in range(levels.shape[1])]
            out.append((order, cuts))
        return out

    def _segment(self, direction: int, d: int, level: int) -> np.ndarray:
        order, cuts = self.lists[direction]
        return order[cuts[d][self.bands - 1 - level] : cuts[d][self.bands - level], d]

    def search(self, q: np.ndarray, own: np.ndarray, k: int, few: int = FEW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vector, score) of all possible members of the queries' k best.
        own: the block's position of the query's own row, or -1."""
        n, m = len(self.x), len(q)
        possible = np.ones((n, m), bool)
        possible[own[own >= 0], np.flatnonzero(own >= 0)] = False
        others = possible.copy()
        weights = (np.maximum(q, 0), np.maximum(-q, 0))
        bound = int((np.abs(q) @ (self.steps * self.bands)).max(initial=0))
        acc = np.zeros((n, m), np.int32 if bound < 2**31 else np.int64)
        # The last level, 0, adds nothing and leaves the bound as it is.
        for level in range(self.bands - 1, 0, -1) if n - 1 > k else ():
            for direction, weight in enumerate(weights):
                for d in np.flatnonzero(weight.any(axis=0)):
                    ids = self._segment(direction, d, level)
                    if len(ids):
                        acc[ids] += (weight[:, d] * (level * self.steps[d])).astype(acc.dtype)
            # Seen postings are short by less than a step; the others are
            # below this level.
            rest = np.abs(q) @ (level * self.steps - 1)
            if level > 1 and level % 4:
                continue
            kth = np.partition(np.where(others, acc, -1), n - k, axis=0)[n - k]
            possible = (acc + rest >= kth) & others
            if possible.sum() <= few * m:
                break
        ids, queries = np.nonzero(possible)
        score = np.empty(len(ids), np.int64)
        some = max(1, BLOCK_CELLS // self.x.shape[1])
        for lo in range(0, len(ids), some):
            part = slice(lo, lo + some)
            score[part] = (self.x[ids[part]] * q[queries[part]]).sum(axis=1)
        return queries, ids, score


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows; zeros after their end, nothing beyond ``width``."""
    length = np.diff(vectors.offsets.to_numpy())
    row = np.repeat(np.arange(len(vectors)), length)
    place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
    out = np.zeros((len(vectors), width), np.int64)
    inside = place < width
    out[row[inside], place[inside]] = vectors.flatten().to_numpy(zero_copy_only=False)[inside]
    return out


class Block:
    """The vectors of one block with their index."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("uid").combine_chunks()
        self.uid, self.ids = rows["uid"].to_numpy(), rows["vec_id"].to_numpy()
        v = pa.concat_arrays(rows["v"].chunks)
        self.width = int(np.diff(v.offsets.to_numpy()).max())
        self.index = Index(_matrix(v, self.width))

    def best(self, queries: pa.RecordBatch, k: int) -> pa.RecordBatch:
        """The block's k best of each query: q_uid, query_id, vec_id, score."""
        q_uid, query_id = queries["uid"].to_numpy(), queries["vec_id"].to_numpy()
        at = np.minimum(np.searchsorted(self.uid, q_uid), len(self.uid) - 1)
        own = np.where(self.uid[at] == q_uid, at, -1)
        query, vector, score = self.index.search(_matrix(queries["v"], self.width), own, k)
        order = np.lexsort((self.ids[vector], -score, query))
        query, vector, score = query[order], vector[order], score[order]
        keep = np.arange(len(query)) - np.searchsorted(query, query) < k
        query, vector, score = query[keep], vector[keep], score[keep]
        columns = (q_uid[query], query_id[query], self.ids[vector], score)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["q_uid", "query_id", "vec_id", "score"])


def _runs(batch: pa.RecordBatch):
    """Slices of one block and kind: (block, whether queries, slice)."""
    b, query = batch["b"].to_numpy(), batch["query"].to_numpy(zero_copy_only=False)
    edge = np.flatnonzero((b[1:] != b[:-1]) | (query[1:] != query[:-1])) + 1
    for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(b)]):
        if hi > lo:
            yield int(b[lo]), bool(query[lo]), batch.slice(lo, hi - lo)


def _stream(k: int):
    """Rows sorted by block, a block's vectors before its queries."""

    def run(batches):
        now, rows, block = None, [], None
        for batch in batches:
            for b, query, part in _runs(batch):
                if b != now:
                    now, rows, block = b, [], None
                if not query:
                    rows.append(part)
                    continue
                if rows:
                    block, rows = Block(pa.Table.from_batches(rows)), []
                if block is None:  # no vector was dealt to this block
                    continue
                some = max(1, min(AT_ONCE, QUERY_CELLS // block.width))
                for lo in range(0, len(part), some):
                    yield block.best(part.slice(lo, some), k)

    return run


def _blocks(counts: dict[int, int]) -> dict[int, tuple[int, int]]:
    """(first block, number of blocks) of each class of length: class c holds
    vectors of at most 2**c components."""
    out, first = {}, 0
    for c, n in sorted(counts.items()):
        blocks = -(-n // max(1, min(BLOCK_ROWS, BLOCK_CELLS >> c)))
        out[c] = (first, blocks)
        first += blocks
    return out


def search(vectors: DataFrame, is_query, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best.
    is_query: a condition on the column ``vec_id``."""
    sound = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
        .where((F.size("x") > 0) & F.col("vec_id").isNotNull() & sound)
        .select(F.monotonically_increasing_id().alias("uid"), "vec_id", F.transform("x", lambda c: F.floor(c * 256).cast("long")).alias("v"))
    )
    rows = scratch(rows, "tk-rows")
    length_class = F.length(F.bin(F.size("v") - 1))
    # One row per class: at most 31.
    blocks = _blocks({r.c: r.n for r in rows.groupBy(length_class.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()})
    total = max(1, sum(n for _, n in blocks.values()))
    block = F.lit(0)
    for c, (first, n) in blocks.items():
        block = F.when(length_class == c, first + F.pmod(F.xxhash64("uid"), F.lit(n))).otherwise(block)
    own = rows.select(block.cast("int").alias("b"), F.lit(False).alias("query"), "uid", "vec_id", "v")
    asked = rows.where(is_query).select(
        F.explode(F.sequence(F.lit(0), F.lit(total - 1))).alias("b"), F.lit(True).alias("query"), "uid", "vec_id", "v"
    )
    dealt = own.unionAll(asked).repartitionById(total, F.col("b")).sortWithinPartitions("b", "query")
    found = dealt.mapInArrow(_stream(k), "q_uid bigint, query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("q_uid").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def digest(embeddings: DataFrame) -> DataFrame:
    return search(embeddings, F.col("vec_id") % 50 == 0)


# DuckDB form of digest(embeddings).
DIGEST_SQL = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
c AS (SELECT rid, vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM v),
s AS (SELECT q.rid AS q_rid, q.vec_id AS query_id, c.rid, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
      FROM c AS q JOIN c ON q.d = c.d AND q.rid <> c.rid WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY q_rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
