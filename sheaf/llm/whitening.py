"""Embedding whitening: distributed centred scatter, eigenvectors by cyclic Jacobi rotations.

Tasks sum integers per dimension, then, given the exact sums, the products of centred vectors. What
meets on the driver is one matrix of the dimensions, whatever the number of vectors. There, Jacobi
rotations turn the symmetric matrix until its off-diagonal entries vanish, each small against its
own row's and column's diagonal entries, so small eigenvalues are as right as large ones. The
whitening matrix goes back to the tasks, which project their vectors.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.shared import arrow_rows

#: Most dimensions: the driver holds matrices of this size squared (32 MB), a task one or two.
MOST_DIMS = 2048
#: Entries become whole numbers: floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Components that are returned.
COMPONENTS = 32
SWEEPS = 60


def whole(vector: Column) -> Column:
    """The vector as long integers; null where it or an entry is null, or an entry is not finite."""
    c = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(c, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when(fine, F.transform(c, lambda x: F.floor(x * SCALE).cast("long") + OFFSET))


def vectors(rows: DataFrame) -> DataFrame:
    """vec_id and x of the rows that stay."""
    return rows.select("vec_id", whole(F.col("embedding")).alias("x")).where(F.col("x").isNotNull() & (F.size("x") > 0))


def dimension(xs: DataFrame) -> int:
    """The most frequent length, of ties the largest; 0 without vectors."""
    top = xs.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if top and top["d"] > MOST_DIMS:
        raise ValueError(f"vectors of {top['d']} dimensions; at most {MOST_DIMS}")
    return top["d"] if top else 0


def _matrix(column, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def sums(xs: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension: a row a task and dimension shuffles."""

    def run(batches):
        n, s = 0, [0] * dims
        for b in batches:
            n += b.num_rows
            s = [x + int(y) for x, y in zip(s, _matrix(b.column("x"), dims).sum(0), strict=True)]
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(dims), pa.int32()), "n": pa.array([n] * dims, pa.int64()), "s": pa.array(map(str, s), pa.string())})

    parts = arrow_rows(xs.select("x"), run, "i int, n long, s string", 0)
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    return (found[0]["n"] if found else 0), [int(r["s"]) for r in sorted(found, key=lambda r: r["i"])]


def scatter(rows: DataFrame, column: str, dims: int, centred: Callable[[np.ndarray], np.ndarray], n: int) -> np.ndarray:
    """The covariance (divisor n) of ``centred`` of the rows' vectors. Each task adds up one matrix;
    its rows shuffle by number, entry by entry, so that no task holds more than its own."""

    def run(batches):
        total = np.zeros((dims, dims))
        for b in batches:
            if b.num_rows:
                y = centred(_matrix(b.column(column), dims))
                total += y.T @ y
        for i in range(dims):
            yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "v": pa.array([total[i]], pa.list_(pa.float64()))})

    parts = arrow_rows(rows.select(column), run, "i int, v array<double>", 0)
    found = parts.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((dims, dims))
    for r in found.toLocalIterator():
        out[r["i"], r["j"]] = r["v"]
    return (out + out.T) / (2 * n)


def rounds(d: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A sweep: every pair once, in rounds of pairs that share no index (round robin)."""
    ring = list(range(d + d % 2))
    out = []
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(min(p, q), max(p, q)) for p, q in zip(ring[:half], reversed(ring[half:]), strict=True) if max(p, q) < d]
        out.append((np.array([p for p, _ in pairs], int), np.array([q for _, q in pairs], int)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def jacobi(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, by cyclic Jacobi
    rotations. The pairs of a round share no index, so their rotations are one step.

    A pair is done when its entry is below rounding against its two diagonal entries.
    """
    a, d = np.array(a, float), len(a)
    v = np.eye(d)
    order = rounds(d)
    for _ in range(SWEEPS):
        turned = 0
        for p, q in order:
            apq, app, aqq = a[p, q], a[p, p], a[q, q]
            live = np.abs(apq) > 1e-16 * np.sqrt(np.abs(app * aqq))
            p, q = p[live], q[live]
            if not len(p):
                continue
            turned += len(p)
            apq, gap = apq[live], (aqq - app)[live]
            # tan of the smaller angle that makes the entry vanish; hypot cannot overflow
            t = np.where(gap >= 0, 1.0, -1.0) * 2 * apq / (np.abs(gap) + np.hypot(gap, 2 * apq))
            c = 1 / np.sqrt(1 + t * t)
            s = t * c
            for m in (a.T, a, v.T):  # columns of a, rows of a, columns of v
                x, y = m[p], m[q]
                m[p], m[q] = c[:, None] * x - s[:, None] * y, s[:, None] * x + c[:, None] * y
            a[p, q] = a[q, p] = 0.0
        if not turned:
            break
    e = np.diag(a)
    by = np.argsort(-e, kind="stable")
    return e[by], v[:, by] / np.linalg.norm(v[:, by], axis=0)


def fit(xs: DataFrame, dims: int) -> dict:
    """n, sums, eigenvalues and eigenvectors of the vectors, and the trace of their covariance."""
    n, s = sums(xs, dims)
    cov = scatter(xs, "x", dims, _centring(n, s), n)
    e, v = jacobi(cov)
    return {"n": n, "sums": s, "values": e, "vectors": v, "trace": float(np.trace(cov))}


def _centring(n: int, s: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """x - S/n, rounded once: whole part and remainder of the mean are taken off in turn."""
    mean, rest = np.array([k // n for k in s], np.int64), np.array([(k % n) / n for k in s])
    return lambda x: (x - mean).astype(float) - rest


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector that stays: vec_id, n, deviation, w (array, a double a component),
    explained (array) and identity_error.

    Vectors that are null, empty, or hold null or non-finite entries are left out, and so are those
    that have not the most frequent length (of ties the largest). Components without variance
    (eigenvalues within rounding of 0 against the largest) are left out too, so equal vectors alone
    give empty arrays and an error of 0. Repeated vectors count each time; repeated and null vec_ids
    stay. Other columns are not read. An empty table gives no rows. Entries beyond 2**63 / 64, and
    deviations beyond a long, fail.
    """
    spark = rows.sparkSession
    xs = vectors(rows)
    dims = dimension(xs)
    schema = "vec_id long, n long, deviation long, w array<double>, explained array<double>, identity_error double"
    if not dims:
        return spark.createDataFrame([], schema)
    xs = xs.where(F.size("x") == dims)
    found = fit(xs, dims)
    n, s, e = found["n"], found["sums"], found["values"]
    live = int((e > max(e[0], 0) * dims * np.finfo(float).eps).sum())
    k = min(components, live)
    turn = found["vectors"][:, :k] / np.sqrt(e[:k])
    centred = _centring(n, s)
    # the error is that of the rows as they come out, so they are projected, centred and multiplied
    cov = scatter(xs, "x", dims, lambda x: _padded(centred(x) @ turn, dims), n)[:k, :k]
    error = float(np.abs(cov - np.eye(k)).max()) if k else 0.0

    def run(batches):
        for b in batches:
            w = centred(_matrix(b.column("x"), dims)) @ turn
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("x"), pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), k).cast(pa.list_(pa.float64())) if k else pa.array([[]] * b.num_rows, pa.list_(pa.float64()))], ["vec_id", "x", "w"])

    kind = dict(xs.dtypes)["vec_id"]
    out = arrow_rows(xs, run, f"vec_id {kind}, x array<bigint>, w array<double>", 0)
    total = F.array(*[F.lit(str(v)).cast("decimal(38,0)").cast("bigint") for v in s])
    deviation = F.aggregate(F.zip_with("x", total, lambda x, t: x * F.lit(n).cast("long") - t), F.lit(0).cast("long"), lambda a, y: a + y * y)
    share = F.array(*[F.lit(float(x / found["trace"])) for x in e[:k]]).cast("array<double>")
    return out.select("vec_id", F.lit(n).cast("long").alias("n"), deviation.alias("deviation"), "w", share.alias("explained"), F.lit(error).alias("identity_error"))


def _padded(y: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(y, ((0, 0), (0, dims - y.shape[1])))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    out = out.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("w", "explained")).alias("at", "of"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("of.w").alias("whitened"), F.col("of.explained").alias("explained"), "identity_error")
