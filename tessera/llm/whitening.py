"""Embedding whitening from the exact characteristic polynomial.

Entries become integers, x = floor(1024 * c) + 100000. One pass sums, in
integers without any rounding, the number of vectors, the sums S and the
scatter matrix, as Spark aggregates of the tasks' partial sums. The matrix
A = n * sum(x x') - S S' is n * n times the covariance and has integer entries.
Its characteristic polynomial is computed modulo many primes, dealt over the
cluster (``charpoly.residues``), and put together by Chinese remaindering; its
largest roots are isolated with exact counts, and the components are the null
spaces of A - root by inverse iteration in high precision. A second pass
measures the covariance of the whitened rows against the identity, centred by
merged means before anything is multiplied; a third returns them.

What passes through the driver depends on the number of dimensions d only: the
d * (d + 1) / 2 entries of A, and d + 1 residues per prime.

Defined results: rows whose vector is null, empty, or holds a null or
non-finite entry take no part; vectors are of the most common length (of the
shorter one, if tied), others take no part either; entries whose integer does
not fit 62 bits count as the nearest that does; null ids and repeated rows are
rows like any other. A component without variance cannot be whitened: with
less than eight positive eigenvalues there are less components, with one row,
or equal rows only, there are none and the result is empty. Of equal
eigenvalues any orthonormal basis is taken. Each component's entry of largest
size is positive. A deviation beyond a long is null and given as text in
``deviation_exact``. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import charpoly

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
LIMB = 21  # bits of a limb: products of two limbs over 2048 rows fit a double
DIGIT = 40  # bits of a digit in which the tasks' sums are added up in longs
ELEMENTS = 1 << 20  # entries that a task holds as a matrix at a time
PRIMES_A_TASK = 16


@dataclass
class Whitening:
    n: int
    dims: int
    sums: list[int]
    variances: list[float]
    shares: list[float]
    axes: list[list[float]]


def integer_rows(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and the integers x - OFFSET of the vectors that take part in any way."""
    sound = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    most = F.lit(1 << 62)
    return (
        vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("c"))
        .where((F.size("c") > 0) & sound)
        .select("vec_id", F.transform("c", lambda c: F.greatest(F.least(F.floor(c * SCALE), most), -most).cast("long")).alias("x"))
    )


def _matrices(batches, dims: int):
    """(ids, matrix of longs) in pieces of a bounded number of entries."""
    step = max(1, ELEMENTS // dims)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part.column(0), part.column(1).flatten().to_numpy().reshape(-1, dims)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """x as sum of limb[k] << (LIMB * k), as doubles."""
    out, half = [], 1 << (LIMB - 1)
    while x.any() or not out:
        low = ((x + half) & ((1 << LIMB) - 1)) - half
        out.append(low.astype(np.float64))
        x = (x - low) >> LIMB
    return out


def _scatter(x: np.ndarray) -> np.ndarray:
    """x' x with a column of ones in front, as exact Python integers."""
    total = np.zeros((x.shape[1] + 1,) * 2, object)
    for at in range(0, len(x), 2048):
        part = x[at : at + 2048]
        limbs = _limbs(np.concatenate([np.ones((len(part), 1), np.int64), part], axis=1))
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def _scatter_digits(dims: int):
    """A task's scatter matrix: rows (i, j, place, digit) for j >= i."""
    mask, half = (1 << DIGIT) - 1, 1 << (DIGIT - 1)

    def run(batches):
        total = np.zeros((dims + 1,) * 2, object)
        for _, x in _matrices(batches, dims):
            total += _scatter(x)
        place, (i, j) = 0, np.triu_indices(dims + 1)
        left = total[i, j]
        while left.any():
            digit = ((left + half) & mask) - half
            some = digit != 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(i[some], pa.int32()), pa.array(j[some], pa.int32()),
                 pa.array(np.full(some.sum(), place), pa.int32()), pa.array(digit[some].astype(np.int64))],
                names=["i", "j", "place", "digit"],
            )
            left = (left - digit) >> DIGIT
            place += 1

    return run


def _scatter_of(rows: DataFrame, dims: int) -> list[list[int]]:
    """The (d + 1) x (d + 1) scatter of all rows; entry (0, 0) is their number."""
    digits = (
        rows.select("vec_id", "x")
        .mapInArrow(_scatter_digits(dims), "i int, j int, place int, digit bigint")
        .groupBy("i", "j", "place")
        .agg(F.sum("digit").alias("digit"))
    )
    out = [[0] * (dims + 1) for _ in range(dims + 1)]
    for r in digits.collect():  # d * d entries of few digits
        out[r.i][r.j] += r.digit << (DIGIT * r.place)
    for i in range(dims + 1):
        for j in range(i):
            out[i][j] = out[j][i]
    return out


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients, lowest first, of a positive semidefinite integer
    matrix; each task takes ``PRIMES_A_TASK`` primes."""
    d = len(matrix)
    moduli = charpoly.primes(charpoly.coefficient_bits(sum(matrix[i][i] for i in range(d)), d))
    groups = [moduli[at : at + PRIMES_A_TASK] for at in range(0, len(moduli), PRIMES_A_TASK)]

    def run(batches):
        for batch in batches:
            for g in batch.column(0).to_pylist():
                rows = charpoly.residues(matrix, groups[g])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(groups[g], pa.int64()), pa.array(rows.tolist(), pa.list_(pa.int64()))], names=["modulus", "residues"]
                )

    found = spark.range(0, len(groups), 1, len(groups)).mapInArrow(run, "modulus bigint, residues array<bigint>").collect()
    return charpoly.combine([r.modulus for r in found], [r.residues for r in found])


def fit(rows: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """rows: vec_id, x of ``integer_rows``. None without rows."""
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return None
    dims = common.d
    scatter = _scatter_of(rows.where(F.size("x") == dims), dims)
    n, sums = scatter[0][0], scatter[0][1:]
    matrix = [[n * scatter[i + 1][j + 1] - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    trace = sum(matrix[i][i] for i in range(dims))
    found = []
    if trace:
        poly = characteristic_polynomial(rows.sparkSession, matrix)
        found = charpoly.components(matrix, charpoly.top_roots(poly, k), k)
    variance = trace / (n * n)
    return Whitening(n, dims, sums, [s * variance for s, _ in found], [s for s, _ in found], [u for _, u in found])


def _centred(model: Whitening):
    """x -> x - S / n as doubles: whole parts are subtracted as integers."""
    whole = np.array([s // model.n for s in model.sums], np.int64)
    rest = np.array([s % model.n / model.n for s in model.sums])
    return lambda x: (x - whole).astype(np.float64) - rest


def _project(model: Whitening):
    axes = np.array(model.axes).T / np.sqrt(np.array(model.variances))
    centred = _centred(model)
    return lambda x: centred(x) @ axes


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """sum((n * x - S) ** 2) of each row, exact."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], object)
    y = x - whole
    largest = n * (int(np.abs(y).max(initial=0)) + 1)
    if x.shape[1] * largest * largest < 1 << 63:
        y = y * n - rest.astype(np.int64)
        return (y * y).sum(axis=1).tolist()
    y = y.astype(object) * n - rest
    return (y * y).sum(axis=1).tolist()


def _moments(model: Whitening):
    """A task's number of rows, means and centred products of whitened rows."""
    project, k = _project(model), len(model.axes)

    def run(batches):
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for _, x in _matrices(batches, model.dims):
            z = project(x)
            m = z.mean(axis=0)
            step, both = m - mean, n + len(z)
            products += (z - m).T @ (z - m) + np.outer(step, step) * (n * len(z) / both)
            mean, n = mean + step * (len(z) / both), both
        if n:
            a, b = np.indices((k, k)).reshape(2, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(np.full(k * k, float(n))),
                 pa.array(mean[a]), pa.array(mean[b]), pa.array(products.ravel())],
                names=["a", "b", "n", "ma", "mb", "m"],
            )

    return run


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    parts = rows.mapInArrow(_moments(model), "a int, b int, n double, ma double, mb double, m double")
    whole = parts.groupBy("a", "b").agg(
        F.sum("n").alias("n"), F.sum("m").alias("m"), F.sum(F.col("n") * F.col("ma") * F.col("mb")).alias("between"),
        F.sum(F.col("n") * F.col("ma")).alias("sa"), F.sum(F.col("n") * F.col("mb")).alias("sb"),
    )
    covariance = (F.col("m") + F.col("between") - F.col("sa") * F.col("sb") / F.col("n")) / F.col("n")
    one = F.when(F.col("a") == F.col("b"), 1.0).otherwise(0.0)
    return whole.agg(F.max(F.abs(covariance - one))).first()[0]


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error and
    deviation_exact of every row that takes part and each component."""
    spark = vectors.sparkSession
    rows = integer_rows(vectors, vec_id, embedding)
    kind = rows.schema["vec_id"].dataType.simpleString()
    model = fit(rows, k)
    if model is None or not model.axes:
        return spark.createDataFrame(
            [], f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, deviation_exact string"
        )
    used = rows.where(F.size("x") == model.dims)
    error = identity_error(used, model)
    project = _project(model)

    def run(batches):
        for ids, x in _matrices(batches, model.dims):
            exact = deviations(x, model.n, model.sums)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([e if e < 1 << 63 else None for e in exact], pa.int64()),
                    pa.array([None if e < 1 << 63 else str(e) for e in exact], pa.string()),
                    pa.array(project(x).tolist(), pa.list_(pa.float64())),
                ],
                names=["vec_id", "deviation", "deviation_exact", "w"],
            )

    shares = F.array(*[F.lit(s) for s in model.shares])
    out = used.mapInArrow(run, f"vec_id {kind}, deviation bigint, deviation_exact string, w array<double>")
    return out.select("vec_id", "deviation", "deviation_exact", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
        "deviation_exact",
    )


def digest(embeddings: DataFrame) -> DataFrame:
    return whiten(embeddings)
