"""Embedding whitening by the exact characteristic polynomial (operator 11).

Entries become integers, so the scatter matrix M = n * sum(x x') - S S' of the distinct vectors is
exact; the covariance is M / n^2. Spark sums it over the vectors: what leaves a task, and what the driver
gets, are numbers of the dimension squared, whatever the number of vectors.

Then, by the dimension alone: the characteristic polynomial of M modulo many primes by Hessenberg
reduction (a Spark task takes some primes), put together by Chinese remaindering. M has only
real eigenvalues and none below 0, so the coefficients' signs are known, and Descartes' rule is exact: the
roots above a are the sign changes of the polynomial moved by a. Bisection with that count isolates
the wanted roots in integers, with a single root the polynomial's sign goes on, to 160 bits. Inverse
iteration in long decimals on M minus the root gives the null vector (a Spark task takes a component);
roots that don't part at that precision share a null space, in which vectors are made orthogonal.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from decimal import Decimal, localcontext
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import stored

#: Bits to which a root is found, and decimal digits of the inverse iteration.
ROOT_BITS, DIGITS = 160, 120
#: Sums are cut into a high and a low part at this number, so that their columns don't overflow.
CUT = 10**18
#: Products summed in doubles stay exact below this.
EXACT = 2.0**53


# -- integer scatter ---------------------------------------------------------------------------

def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Long lists of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _products(y: np.ndarray) -> np.ndarray:
    """y'y exactly, as Python ints."""
    most = float(np.abs(y.astype(np.float64)).max(initial=0))
    if most * most * max(len(y), 1) < EXACT:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    return y.astype(object).T @ y.astype(object)


def scatter(fit: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """Number, sum and scatter n * sum(x x') - S S' of the vectors ``x`` (arrays of ``dim`` longs), exactly."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1), object)
        for batch in batches:
            y = np.ones((batch.num_rows, dim + 1), np.int64)
            y[:, 1:] = _matrix(batch.column(0), dim)
            total = total + _products(y)
        i, j = np.triu_indices(dim + 1)
        cells = [int(v) for v in total[i, j]]
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays([pa.array(i * (dim + 1) + j, pa.int64()), *(pa.array([Decimal(f(v, CUT)) for v in cells], kind) for f in (int.__floordiv__, int.__mod__))], ["cell", "high", "low"])

    sums = fit.select("x").mapInArrow(run, "cell long, high decimal(38,0), low decimal(38,0)").groupBy("cell").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    g = [[0] * (dim + 1) for _ in range(dim + 1)]
    for cell, high, low in sums.collect():  # (dim + 1)(dim + 2) / 2 rows
        i, j = divmod(cell, dim + 1)
        g[i][j] = g[j][i] = int(high) * CUT + int(low)
    n, s = g[0][0], g[0][1:]
    return n, s, [[n * g[i + 1][j + 1] - s[i] * s[j] for j in range(dim)] for i in range(dim)]


# -- characteristic polynomial -----------------------------------------------------------------

def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number below 3.2e9."""
    if any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(r - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2^31, the largest first, whose product exceeds ``bound``."""
    out, product, p = [], 1, 2**31 - 1
    while product <= bound:
        if _is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomial_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(t - a) modulo a prime below 2^31, the constant first."""
    h, d = a.copy(), len(a)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        if s := below[0]:
            h[[k, k + s]] = h[[k + s, k]]
            h[:, [k, k + s]] = h[:, [k + s, k]]
        f = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - f[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * f % p).sum(axis=1)) % p
    minors = np.zeros((d + 1, d + 1), np.int64)
    minors[0, 0] = 1
    for k in range(d):
        t, path = np.empty(k + 1, np.int64), 1
        for i in range(k, -1, -1):  # the path along the diagonal below, up to row i
            t[i] = int(h[i, k]) * path % p
            path = path * int(h[i, i - 1]) % p if i else 0
        minors[k + 1, 1:] = minors[k, :-1]
        minors[k + 1] = (minors[k + 1] - (t[:, None] * minors[: k + 1] % p).sum(axis=0)) % p
    return minors[d]


def characteristic(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """e_0 .. e_d of det(t - m) = sum of (-1)^k e_k t^(d-k), for a matrix without negative eigenvalues."""
    d, trace = len(m), sum(m[i][i] for i in range(len(m)))
    # no e_k is larger than that of d equal eigenvalues
    bound = max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))
    primes = primes_beyond(bound)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array(m, object).reshape(d, d)
        for batch in batches:
            for p in batch.column(0).to_pylist():
                c = polynomial_mod((whole % p).astype(np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([c.tolist()], pa.list_(pa.int64()))], ["p", "c"])

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInArrow(run, "p long, c array<long>")
    found, product = [0] * (d + 1), 1
    for p, c in rows.collect():  # d + 1 numbers for each prime
        inverse = pow(product, -1, p)
        found = [x + product * ((r - x) * inverse % p) for x, r in zip(found, c, strict=True)]
        product *= p
    return [(-1) ** k * found[d - k] % product for k in range(d + 1)]


# -- roots and components ----------------------------------------------------------------------

def roots_above(e: list[int], a: int) -> int:
    """Roots of sum (-1)^k e_k t^(d-k) above ``a``: sign changes of the polynomial moved by ``a``."""
    c = [-x if k % 2 else x for k, x in enumerate(e)]
    for end in range(len(c), 1, -1):
        c[:end] = accumulate(c[:end], lambda s, x: s * a + x)
    signs = [x > 0 for x in c if x]
    return sum(u != v for u, v in zip(signs, signs[1:], strict=False))


def _sign(e: list[int], a: int) -> int:
    value = 0
    for k, x in enumerate(e):
        value = value * a + (-x if k % 2 else x)
    return (value > 0) - (value < 0)


def isolate(e: list[int], index: int, bits: int = ROOT_BITS) -> tuple[int, int, int, int]:
    """``(low, high, shift, above)``: the root number ``index`` (1: the largest; it must be above 0) lies in
    (low, high] / 2^shift, to ``bits`` bits, and ``above`` roots lie above."""
    while e[-1] == 0:
        e = e[:-1]  # roots that are 0
    shift, c = 0, e
    while roots_above(c, 1 << bits) < index:
        shift += 64
        c = [x << shift * k for k, x in enumerate(e)]
    low, high, under, above = 1 << bits, max(c[1], 1 << bits), None, 0  # e_1 is the trace
    while high - low > max(1, high >> bits):
        mid = (low + high) // 2
        if under is not None and under - above == 1:
            sign = _sign(c, mid)
            if sign == 0:
                return mid - 1, mid, shift, above
            below = sign != (-1) ** above
        else:
            now = roots_above(c, mid)
            below = now >= index
            under, above = (now, above) if below else (under, now)
        low, high = (mid, high) if below else (low, mid)
    return low, high, shift, above


def _solve(lower: list, upper: np.ndarray, b: np.ndarray) -> np.ndarray:
    for k, (s, f) in enumerate(lower):
        b[[k, s]] = b[[s, k]]
        b[k + 1 :] = b[k + 1 :] - f * b[k]
    for k in range(len(b) - 1, -1, -1):
        b[k] = (b[k] - (upper[k, k + 1 :] * b[k + 1 :]).sum()) / upper[k, k]
    return b


def null_vectors(m: list[list[int]], root: Decimal, count: int, digits: int = DIGITS) -> list[np.ndarray]:
    """``count`` orthogonal unit vectors of the null space of m - root, by inverse iteration."""
    d = len(m)
    with localcontext() as context:
        context.prec = digits
        a = np.array([[Decimal(x) for x in row] for row in m], object).reshape(d, d)
        a[np.diag_indices(d)] -= root
        least, lower = max(abs(root), Decimal(1)).scaleb(5 - digits), []
        for k in range(d):
            s = k + int(np.argmax(np.abs(a[k:, k])))
            a[[k, s]] = a[[s, k]]
            if abs(a[k, k]) < least:
                a[k, k] = least
            f = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k:] = a[k + 1 :, k:] - np.multiply.outer(f, a[k, k:])
            lower.append((s, f))
        out: list[np.ndarray] = []
        for j in range(count):
            v = np.array([Decimal((i + 1) * 2654435761 * (j + 1) % 2**32) / 2**32 + 1 for i in range(d)], object)
            for _ in range(60):
                last = v
                v = _solve(lower, a, v.copy())
                for _ in range(2):
                    for u in out:
                        v = v - (u * v).sum() * u
                    v = v / (v * v).sum().sqrt()
                gap = min(np.abs(v - last).max(), np.abs(v + last).max())
                if gap < Decimal(10) ** -40:
                    break
            out.append(v)
        return out


def component(m: list[list[int]], e: list[int], index: int) -> tuple[Decimal, list[float]]:
    """Eigenvalue of m and unit eigenvector number ``index`` (1: the largest eigenvalue)."""
    low, high, shift, above = isolate(e, index)
    with localcontext() as context:
        context.prec = DIGITS
        root = (Decimal(low) + Decimal(high)) / 2 / Decimal(2) ** shift
    v = null_vectors(m, root, index - above)[-1]
    return root, [float(x) for x in v]


def components(spark: SparkSession, m: list[list[int]], k: int) -> list[tuple[Decimal, list[float]]]:
    """The first ``k`` eigenvalues above 0 of m, and their vectors."""
    e = characteristic(spark, m)
    k = min(k, max(i for i, x in enumerate(e) if x))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for index in batch.column(0).to_pylist():
                root, v = component(m, e, index)
                yield pa.RecordBatch.from_arrays([pa.array([index], pa.int64()), pa.array([str(root)]), pa.array([v], pa.list_(pa.float64()))], ["i", "root", "v"])

    if not k:
        return []
    rows = spark.range(1, k + 1, 1, k).mapInArrow(run, "i long, root string, v array<double>").collect()
    return [(Decimal(root), v) for _, root, v in sorted(rows)]


# -- whitening ---------------------------------------------------------------------------------

def _deviations(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n x - S exactly: longs where they fit, else Python ints."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if n * most + max(map(abs, s)) < 2**62:
        return n * x - np.array(s, np.int64)
    return n * x.astype(object) - np.array(s, object)


def _squares(t: np.ndarray) -> pa.Array:
    """Sum of squares of each row as an exact decimal; null where that has over 38 digits."""
    if t.dtype != object and t.shape[1] * max(abs(int(t.max(initial=0))), abs(int(t.min(initial=0)))) ** 2 < 2**63:
        return pa.array((t * t).sum(axis=1)).cast(pa.decimal128(38, 0))
    t = t.astype(object)
    return pa.array([Decimal(v) if v < 10**38 else None for v in map(int, (t * t).sum(axis=1))], pa.decimal128(38, 0))


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 4, scale: int = 256) -> DataFrame:
    """A row per component and row of ``vectors`` whose vector is not null and holds finite numbers only
    (other rows go): the key as ``vec_id``, ``component`` (from 1), ``n``, ``deviation`` (decimal), ``whitened``, ``explained``,
    ``identity_error``.

    An entry c counts as floor(scale * c), limited to the range of a long. The fit takes every distinct vector once,
    so repeated rows weigh no more. Components have falling eigenvalues; of equal ones any orthogonal vectors.
    Eigenvalues that are 0 give no component: one distinct vector, or an empty table, gives no rows. A vector shorter than the
    longest counts as having zeros behind; an empty one as zeros. A key may be null or repeated. Only the two columns are read, so other
    columns of any name don't matter. Time grows with the cube, memory with the square of the longest vector.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 0
    rows = rows.select("vec_id", F.transform(F.concat(v, F.array_repeat(F.lit(0.0), F.lit(dim) - F.size(v))), lambda c: F.floor(c * float(scale))).alias("x"))
    fields = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = rows.select("vec_id", *[F.lit(None).cast(t).alias(f) for f, t in zip(fields[1:], ["int", "long", "decimal(38,0)", "double", "double", "double"], strict=True)]).schema
    if not dim:
        return spark.createDataFrame([], schema)
    fit = stored(rows.select("x").distinct(), "fit")
    n, s, m = scatter(fit, dim)
    found = components(spark, m, k)
    if not found:
        return spark.createDataFrame([], schema)
    trace, size = sum(m[i][i] for i in range(dim)), len(found)
    # x - S/n on the vectors, over the root of the covariance's eigenvalue: n cancels
    onto = np.array([v for _, v in found]).T / np.array([float(root.sqrt()) for root, _ in found])
    explained = np.array([float(root / trace) for root, _ in found])

    def whitened(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        t = _deviations(x, n, s)
        return t, t.astype(np.float64) @ onto

    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = whitened(_matrix(batch.column(0), dim))[1]
            mean = w.mean(axis=0)
            products = (w - mean).T @ (w - mean)
            yield pa.RecordBatch.from_arrays([pa.array([len(w)], pa.int64()), pa.array([mean.tolist()], pa.list_(pa.float64())), pa.array([products.ravel().tolist()], pa.list_(pa.float64()))], ["n", "mean", "products"])

    parts = fit.mapInArrow(moments, "n long, mean array<double>, products array<double>")
    mean = [F.col("mean")[i] for i in range(size)]
    sums = parts.agg(
        *[F.sum(F.col("n") * a).alias(f"m{i}") for i, a in enumerate(mean)],
        *[F.sum(F.col("products")[i * size + j] + F.col("n") * mean[i] * mean[j]).alias(f"c{i}_{j}") for i in range(size) for j in range(size)],
    ).first()
    error = max(abs(sums[f"c{i}_{j}"] / n - sums[f"m{i}"] * sums[f"m{j}"] / n**2 - (i == j)) for i in range(size) for j in range(size))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, w = whitened(_matrix(batch.column(1), dim))
            rows, at = len(t), pa.array(np.repeat(np.arange(len(t)), size))
            columns = [batch.column(0).take(at), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), rows)), pa.array(np.full(rows * size, n, np.int64)), _squares(t).take(at), pa.array(w.ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * size, error))]
            yield pa.RecordBatch.from_arrays(columns, fields)

    return rows.mapInArrow(run, schema)
