"""Whitening of an embedding table by Chebyshev-filtered subspace iteration.

Vectors are scaled to whole numbers, so their count and sums per dimension are exact and centring is one
correctly rounded division. The covariance V itself is never built: a pass over the table
multiplies it with a block of vectors, each task adding up X'(XQ) of its own rows, centred, and
Spark summing the tasks' rows per dimension. A block of somewhat more vectors than wanted is driven
through a Chebyshev polynomial in V, by its three-term recurrence, one pass per degree: the polynomial
stays small over the unwanted part of the spectrum (from zero to the block's smallest Ritz value) and
grows steeply beyond it. Then QR and Rayleigh-Ritz give new Ritz pairs, with their
residuals from the same pass, until every wanted pair is certified: its residual is at rounding level
or, divided by the gap to the next eigenvalue, bounds the error of the eigenvector below `tolerance`.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.llm.common import stored

#: What a vector's entries are multiplied with and then moved by.
FACTOR, SHIFT = 1024, 100_000
#: Vectors iterated beyond the wanted ones, at least and as a multiple.
GUARD, SPARE = 40, 3
#: Degrees of one polynomial at most, and polynomials in all.
DEGREE, ROUNDS = 24, 60


def scaled(rows):
    """`(vec_id, x)` of the rows of `rows(vec_id, embedding)` that take part."""
    given = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (
        F.abs(c) != float("inf")))
    return rows.filter(F.col("embedding").isNotNull()).filter(finite).select(
        "vec_id", F.transform(given, lambda c: F.floor(c * FACTOR) + SHIFT).cast(
            "array<long>").alias("x"))


def _matrix(column, d):
    """An Arrow list column of rows of length d as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _numerators(x, n, sums):
    """n x - S, exact: the whole part of the mean is taken off first, so 64 bits last long."""
    whole, rest = np.divmod(sums, n)
    off = x - whole
    if n > (1 << 62) // (int(np.abs(off).max(initial=0)) + 1):
        off, rest = off.astype(object), rest.astype(object)
    return n * off - rest


def _centred(x, n, sums):
    """x - S / n, rounded once."""
    return _numerators(x, n, sums).astype(np.float64) / n


def _wide(name, k):
    return T.StructType([T.StructField("i", T.IntegerType())] + [
        T.StructField(f"{name}{j}", T.DoubleType()) for j in range(k)])


def times_covariance(table, n, sums, q):
    """V q for a block of vectors: one pass over `table(x)`."""
    d, k = q.shape
    shared = table.sparkSession.sparkContext.broadcast((np.ascontiguousarray(q), sums))

    def run(batches):
        block, centre = shared.value
        total = np.zeros((d, k))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                x = _centred(_matrix(batch.column(0).slice(at, 4096), d), n, centre)
                total += x.T @ (x @ block)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(d, dtype=np.int32)), *(pa.array(total[:, j]) for j in range(k))],
            ["i", *(f"y{j}" for j in range(k))])

    # d rows of k numbers reach the driver, whatever the table's size.
    made = table.select("x").mapInArrow(run, _wide("y", k)).groupBy("i").agg(
        *[F.sum(f"y{j}").alias(f"y{j}") for j in range(k)]).toPandas().sort_values("i")
    shared.unpersist()
    return made.drop(columns="i").to_numpy() / n


def sums_of(table):
    """Rows, sums per dimension, and the trace of the covariance, all from exact numbers."""
    first = table.select(F.size("x").alias("d")).groupBy("d").agg(
        F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(2).collect()
    if len(first) > 1:
        raise ValueError("vectors of different lengths: " + ", ".join(
            str(r["d"]) for r in first))
    if not first or not first[0]["d"]:
        return 0 if not first else first[0]["n"], np.zeros(0, dtype=np.int64), 0.0
    d, n = first[0]["d"], first[0]["n"]
    whole = table.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.sum("v").alias("s"),
        # A square may pass 64 bits in a sum.
        F.sum((F.col("v") * F.col("v")).cast("decimal(38,0)")).alias("s2")).orderBy("i").collect()
    sums = np.array([r["s"] for r in whole], dtype=np.int64)
    trace = sum(n * int(r["s2"]) - int(r["s"]) ** 2 for r in whole) / n / n
    return n, sums[:d], float(trace)


def leading(multiply, d, wanted, tolerance=1e-13, seed=0):
    """The `wanted` largest eigenvalues of a symmetric semidefinite d x d matrix and their
    eigenvectors, certified; `multiply(block)` gives the matrix times a block of vectors."""
    k = min(d, max(wanted + GUARD, SPARE * wanted))
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, k)))[0]
    last = None
    for _ in range(ROUNDS):
        image = multiply(q)
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(values)[::-1]
        values, turn = values[order], turn[:, order]
        q, image = q @ turn, image @ turn
        if k == d or values[0] <= 0:
            return values[:wanted], q[:, :wanted]
        off = np.linalg.norm(image - q * values, axis=0)[:wanted + 1]
        following = np.append(values[1:wanted + 1], 0)[:wanted]
        before = np.append(np.inf, values[:wanted - 1])
        gap = np.minimum(values[:wanted] - following, before - values[:wanted])
        rounding = 4 * np.finfo(float).eps * values[0] * np.sqrt(d)
        settled = (off[:wanted] <= rounding) | (off[:wanted] <= tolerance * np.maximum(gap, 0))
        # At rounding level a further polynomial changes nothing.
        if settled.all() or last is not None and off[:wanted].max() <= 50 * rounding and \
                off[:wanted].max() >= 0.5 * last:
            return values[:wanted], q[:, :wanted]
        last = off[:wanted].max()
        # Damp [0, b]; the wanted end is above it. As many degrees as the residual asks for.
        b = max(values[-1], values[0] * 1e-14)
        reach = max(2 * values[wanted - 1] / b - 1, 1 + 1e-6)
        growth = np.log(reach + np.sqrt(reach * reach - 1))
        need = np.log(max(last / rounding, 10.0)) / growth
        top = 2 * values[0] / b - 1
        # The powers of the largest and the smallest wanted one stay within double precision.
        spread = np.log(top + np.sqrt(max(top * top - 1, 0))) - growth
        degree = int(np.clip(min(need + 2, 25 / max(spread, 1e-3)), 2, DEGREE))
        half = b / 2
        # The scaled recurrence keeps the largest vector near length one.
        sigma = half / (values[0] - half) if values[0] > b else 1.0
        sigma1, before_q = sigma, q
        now = (multiply(q) - half * q) * (sigma1 / half)
        for _ in range(degree - 1):
            sigma2 = 1 / (2 / sigma1 - sigma)
            ahead = (multiply(now) - half * now) * (2 * sigma2 / half) - sigma * sigma2 * before_q
            before_q, now, sigma = now, ahead, sigma2
        q = np.linalg.qr(now)[0]
    raise RuntimeError("the eigenvectors were not certified")


def _deviations(x, n, sums):
    """Sums over dimensions of (n x - S)^2, exact; one beyond 64 bits raises OverflowError."""
    off = _numerators(x, n, sums)
    if float(np.abs(off).max(initial=0)) ** 2 * max(x.shape[1], 1) > 1 << 62:
        off = off.astype(object)
    return pa.array((off * off).sum(axis=1).tolist(), pa.int64())


def whiten(rows, components=8, tolerance=1e-13):
    """`(vec_id, component, n, deviation, whitened, explained, identity_error)` for every vector of
    `rows(vec_id, embedding)` and each of the `components` leading eigenvectors, numbered from 1.

    Vectors that are null or hold null or non-finite entries take no part; null and repeated
    vec_ids are rows like others. Components without variance (below 1e-12 of the whole: single or equal
    rows, fewer rows than components) have no whitened values and do not appear. Other columns are
    not read. An empty table, or vectors without entries, give an empty result; vectors of
    different lengths raise an error.
    """
    spark = rows.sparkSession
    table = stored(scaled(rows), "whitening-table")
    n, sums, trace = sums_of(table)
    d = len(sums)
    schema = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double")
    if not d or trace <= 0:
        return spark.createDataFrame([], schema + ", identity_error double")
    values, vectors = leading(lambda q: times_covariance(table, n, sums, q), d,
                              min(components, d), tolerance)
    keep = int((values > 1e-12 * trace).sum())
    values, vectors = values[:keep], vectors[:, :keep]
    # Either sign is right; the largest entry is made positive so that reruns agree.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(keep)])
    shared = spark.sparkContext.broadcast((sums, vectors / np.sqrt(values), values / trace))
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def run(batches):
        centre, weights, explained = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = _matrix(part.column(1), d)
                white = _centred(x, n, centre) @ weights
                each = np.repeat(np.arange(len(x)), keep)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()).take(pa.array(each)),
                     pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(each), n, dtype=np.int64)),
                     _deviations(x, n, centre).take(pa.array(each)),
                     pa.array(white.ravel()), pa.array(np.tile(explained, len(x)))], names)

    def moments(batches):
        centre, weights, _ = shared.value
        total = np.zeros((keep + 1, keep))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                white = _centred(_matrix(batch.column(0).slice(at, 4096), d), n, centre) @ weights
                total[:keep] += white.T @ white
                total[keep] += white.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(keep + 1, dtype=np.int32)), *(pa.array(c) for c in total.T)],
            ["i", *(f"y{j}" for j in range(keep))])

    # The certificate of the result itself: the covariance of what is returned.
    second = table.select("x").mapInArrow(moments, _wide("y", keep)).groupBy("i").agg(
        *[F.sum(f"y{j}").alias(f"y{j}") for j in range(keep)]).toPandas().sort_values(
        "i").drop(columns="i").to_numpy() / n
    error = np.abs(second[:keep] - np.outer(second[keep], second[keep]) - np.eye(keep)).max()
    return table.select("vec_id", "x").mapInArrow(run, schema).withColumn(
        "identity_error", F.lit(float(error)))
