"""Whitening of integer vectors from the exact characteristic polynomial of their scatter matrix.

Entries become integers, so n^2 times the covariance is an integer matrix, summed without rounding. Its characteristic
polynomial is worked out modulo many primes (one Spark row each: Hessenberg form, then the recurrence over its leading
blocks) and put together by Chinese remaindering. A polynomial with real roots only has as many roots above a as the
polynomial shifted by a has sign changes; that isolates each eigenvalue, and signs of exact values bisect it to some 190
bits. The component is the null space of the matrix less that eigenvalue, by inverse iteration in fixed-point integers.

Only what the dimension bounds meets on the driver: sums, the matrix, one row of residues per prime, the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
LARGEST = 1 << 62
LIMB = 20                 # bits of the signed digits that are multiplied as doubles
BLOCK = 1 << 13           # rows of one product: 2**13 products of 2**38 stay exact in a double
FLUSH = 1 << 8            # products added up before a task gives its partial sums away
ROOT_BITS = 192
FIXED = 384               # fractional bits of the inverse iteration
TOP_PRIME = (1 << 31) - 1


@dataclass(frozen=True)
class Whitening:
    """Fitted components: `vectors[:, k]` is the unit eigenvector of the covariance's (k+1)th largest eigenvalue."""
    n: int
    sums: tuple[int, ...]
    eigenvalues: tuple[float, ...]
    explained: tuple[float, ...]
    vectors: np.ndarray


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """(all columns but the vector's, _vector array<double>) of the rows whose vector is there, not empty and finite."""
    number = F.transform(F.col(vector), lambda c: c.cast("double"))
    finite = F.forall(F.col("_vector"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    others = [c for c in rows.columns if c != vector]
    return rows.select(*others, number.alias("_vector")).where((F.size("_vector") > 0) & finite)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        grid = np.floor(flat * SCALE)
    whole = np.where(np.abs(grid) < LARGEST, grid, 0).astype(np.int64)
    whole[grid >= LARGEST], whole[grid <= -LARGEST] = LARGEST, -LARGEST
    return (whole + SHIFT).reshape(len(column), -1)


def digits(values: np.ndarray) -> list[np.ndarray]:
    """Signed digits of LIMB bits, lowest first, as doubles."""
    out, half = [], 1 << (LIMB - 1)
    while True:
        low = ((values + half) & ((1 << LIMB) - 1)) - half
        out.append(low.astype(np.float64))
        values = (values - low) >> LIMB
        if not values.any():
            return out


def _split(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return value & 0x7FFFFFFF, value >> 31


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, j, weight, lo, hi): partial sums of the digits per length of the vector; j = -1 counts rows."""
    kept: dict[tuple[int, int], np.ndarray] = {}
    rows: dict[int, int] = {}
    for batch in batches:
        column = batch.column("_vector")
        lengths = column.value_lengths().to_numpy(zero_copy_only=False)
        for dim in np.unique(lengths).tolist():
            part = column.filter(pa.array(lengths == dim))
            rows[dim] = rows.get(dim, 0) + len(part)
            for w, digit in enumerate(digits(matrix(part))):
                kept[dim, w] = kept.get((dim, w), 0) + digit.sum(0).astype(np.int64)
    for dim, count in rows.items():
        yield _partial([(dim, -1, 0, np.array([count]))])
    for (dim, w), value in kept.items():
        yield _partial([(dim, j, w, value[j:j + 1]) for j in range(dim)])


def _partial(entries: list) -> pa.RecordBatch:
    value = np.concatenate([e[3] for e in entries])
    lo, hi = _split(value)
    return pa.RecordBatch.from_arrays([pa.array([e[0] for e in entries], pa.int32()), pa.array([e[1] for e in entries], pa.int32()),
                                       pa.array([e[2] for e in entries], pa.int32()), pa.array(lo), pa.array(hi)], ["i", "j", "w", "lo", "hi"])


def _scatter(batches: Iterator[pa.RecordBatch], near: list[int]) -> Iterator[pa.RecordBatch]:
    """(i, j, weight, lo, hi): partial sums of z_i z_j, i <= j, where z is the vector less `near`."""
    dim = len(near)
    upper = np.triu_indices(dim)
    kept: dict[int, np.ndarray] = {}
    added = 0

    def flush():
        for w, value in kept.items():
            lo, hi = _split(value[upper])
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)),
                 pa.array(np.full(len(lo), w, np.int32)), pa.array(lo), pa.array(hi)], ["i", "j", "w", "lo", "hi"])
        kept.clear()

    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            z = digits(matrix(batch.column("_vector").slice(at, BLOCK)) - np.array(near, np.int64))
            for a, left in enumerate(z):
                for b, right in enumerate(z):
                    product = (left.T @ right).astype(np.int64)
                    kept[a + b] = kept[a + b] + product if a + b in kept else product
            added += 1
            if added % FLUSH == 0:
                yield from flush()
    yield from flush()


def _added(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Exact sums by (i, j); as many rows as the dimension allows."""
    out: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("i", "j", "w").agg(F.sum("lo").alias("lo"), F.sum("hi").alias("hi")).toLocalIterator():
        out[r.i, r.j] = out.get((r.i, r.j), 0) + ((r.lo + (r.hi << 31)) << (LIMB * r.w))
    return out


PARTS = "i int, j int, w int, lo long, hi long"


def scatter(rows: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, n^2 times the covariance) of the usable rows, exact. Vectors of another length than the most frequent
    (ties: the longest) take no part."""
    found = _added(rows.select("_vector").mapInArrow(_sums, PARTS))
    counts = {i: v for (i, j), v in found.items() if j == -1}
    if not counts:
        return 0, [], []
    dim = max(counts, key=lambda i: (counts[i], i))
    n, sums = counts[dim], [found[dim, j] for j in range(dim)]
    near = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, near)]
    same = rows.select("_vector").where(F.size("_vector") == dim)
    cross = _added(same.mapInArrow(partial(_scatter, near=near), PARTS))
    both = [[n * cross[min(i, j), max(i, j)] - rest[i] * rest[j] for j in range(dim)] for i in range(dim)]
    return n, sums, both


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide all numbers of 32 bits."""
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def enough_primes(bound: int) -> list[int]:
    """Largest primes of 31 bits whose product exceeds twice `bound`."""
    out, product, p = [], 1, TOP_PRIME
    while product <= 2 * bound:
        if is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def characteristic_mod(square: list[list[int]], p: int) -> np.ndarray:
    """Coefficients of det(xI - A) modulo p, constant first."""
    d = len(square)
    h = np.array([[v % p for v in row] for row in square], np.int64)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        pivot = k + 1 + below[0]
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        ratio = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - ratio[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * ratio % p).sum(1)) % p
    leading = np.zeros((d + 1, d + 1), np.int64)      # polynomials of the leading blocks
    leading[0, 0] = 1
    for k in range(1, d + 1):
        weights = np.empty(k, np.int64)
        chain = 1
        for i in range(k - 1, -1, -1):
            weights[i] = int(h[i, k - 1]) * chain % p
            if i:
                chain = chain * int(h[i, i - 1]) % p
        minus = (weights[:, None] * leading[:k] % p).sum(0)
        leading[k, 1:] = leading[k - 1, :-1]
        leading[k] = (leading[k] - minus) % p
    return leading[d]


def _characteristics(batches: Iterator[pa.RecordBatch], square: list[list[int]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        primes = batch.column("prime").to_pylist()
        if primes:
            yield pa.RecordBatch.from_arrays([pa.array(primes, pa.int64()), pa.array(
                [characteristic_mod(square, p).tolist() for p in primes], pa.list_(pa.int64()))], ["prime", "residues"])


def characteristic(spark, square: list[list[int]]) -> list[int]:
    """Exact coefficients of det(xI - A), constant first, of a positive semidefinite integer matrix."""
    d, trace = len(square), sum(square[i][i] for i in range(len(square)))
    # the k-th coefficient is a sum of products of k eigenvalues, largest when all are equal
    bound = max(math.comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    primes = enough_primes(bound)
    tasks = min(len(primes), 2 * spark.sparkContext.defaultParallelism)
    rows = (spark.createDataFrame([(p,) for p in primes], "prime long").repartition(tasks, "prime")
            .mapInArrow(partial(_characteristics, square=square), "prime long, residues array<long>").collect())
    value, modulus = [0] * (d + 1), 1
    for r in rows:
        inverse = pow(modulus, -1, r.prime)
        value = [v + modulus * ((x - v) * inverse % r.prime) for v, x in zip(value, r.residues)]
        modulus *= r.prime
    return [v - modulus if 2 * v > modulus else v for v in value]


def scaled(poly: list[int], bits: int) -> list[int]:
    """The monic polynomial whose roots are 2**bits times as large."""
    top = len(poly) - 1
    return [c << (bits * (top - j)) for j, c in enumerate(poly)]


def above(poly: list[int], a: int) -> int:
    """Roots greater than a, with multiplicity, of a polynomial that has real roots only: sign changes after a shift by a."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def value_at(poly: list[int], a: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * a + c
    return out


def root(poly: list[int], k: int) -> tuple[int, int, int]:
    """(L, s, place): the k-th largest root lies within 1 / 2**s of L / 2**s, some ROOT_BITS below its leading bit;
    `place` counts from 0 among roots that agree in all those bits. Zero is no root."""
    top = -poly[-2]                                                   # the sum of the roots, none negative
    e = top.bit_length()
    while e > 0 and above(poly, 1 << (e - 1)) < k:                    # now 2**(e-1) < root <= 2**e, or root <= 1
        e -= 1
    while e <= 0 and above(scaled(poly, 1 - e), 1) < k:
        e -= 1
    for bits in (64, ROOT_BITS):
        s = bits - e                                                  # the root is 2**(bits-1) to 2**bits in units of 2**-s
        p = scaled(poly, s) if s >= 0 else poly
        s = max(s, 0)
        lo, hi = (1 << (e + s - 1)), 1 << (e + s)
        under, over = above(p, lo), above(p, hi)
        while hi - lo > 1 and under - over > 1:
            mid = (lo + hi) // 2
            count = above(p, mid)
            if count >= k:
                lo, under = mid, count
            else:
                hi, over = mid, count
        if under - over == 1:
            break
    if under - over > 1:
        return hi, s, k - over - 1
    s = max(ROOT_BITS - e, 0)
    old = max(bits - e, 0)
    p, lo, hi = scaled(poly, s), lo << (s - old), hi << (s - old)
    sign = value_at(p, lo) > 0
    if not value_at(p, lo):
        sign = not value_at(p, hi) > 0
    while hi - lo > 1:
        mid = (lo + hi) // 2
        v = value_at(p, mid)
        if v == 0:
            return mid, s, 0
        if (v > 0) == sign:
            lo = mid
        else:
            hi = mid
    return hi, s, 0


def component(square: list[list[int]], value: int, s: int, place: int) -> np.ndarray:
    """Unit vector of the null space of A - value / 2**s; with equal eigenvalues the `place`-th of an orthogonal set."""
    d = len(square)
    a = np.array([[(v << FIXED) - ((value << FIXED) >> s if i == j else 0) for j, v in enumerate(row)]
                  for i, row in enumerate(square)], object)
    order, lower = list(range(d)), np.zeros((d, d), object)
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(a[i, k]))
        if pivot != k:
            a[[k, pivot]], lower[[k, pivot]] = a[[pivot, k]], lower[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        a[k, k] = a[k, k] or 1
        if k + 1 < d:
            lower[k + 1:, k] = (a[k + 1:, k] << FIXED) // a[k, k]
            a[k + 1:, k + 1:] -= (lower[k + 1:, k, None] * a[k, k + 1:]) >> FIXED

    def solve(b: np.ndarray) -> np.ndarray:
        y = b[order]
        for k in range(1, d):
            y[k] -= int((lower[k, :k] * y[:k]).sum()) >> FIXED
        for k in range(d - 1, -1, -1):
            y[k] = ((y[k] - (int((a[k, k + 1:] * y[k + 1:]).sum()) >> FIXED if k + 1 < d else 0)) << FIXED) // a[k, k]
        return unit(y)

    def unit(y: np.ndarray) -> np.ndarray:
        y = y << FIXED                                                # a start within the space itself may have shrunk
        return (y << FIXED) // max(math.isqrt(int((y * y).sum())), 1)

    found: list[np.ndarray] = []
    for t in range(place + 1):
        mixed = [((i + 1) * 0x9E3779B97F4A7C15 + (t + 1) * 0xBF58476D1CE4E5B9 + i * i * (t + 3) * 0x94D049BB) % 1009 - 504 for i in range(d)]
        y = unit(np.array(mixed, object))
        for _ in range(3):
            y = solve(y)
            for other in found:
                y = y - ((int((y * other).sum()) >> FIXED) * other >> FIXED)
            y = unit(y)
        found.append(y)
    return np.array([int(v >> (FIXED - 80)) / (1 << 80) for v in found[place]], np.float64)


def _components(batches: Iterator[pa.RecordBatch], square: list[list[int]], poly: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in batch.column("component").to_pylist():
            value, s, place = root(poly, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([str(value)]), pa.array([s], pa.int32()),
                 pa.array([component(square, value, s, place).tolist()], pa.list_(pa.float64()))], ["component", "value", "s", "vector"])


def fit(rows: DataFrame, most: int = 32) -> Whitening:
    """Components with an eigenvalue above 0, `most` at most, from all usable rows."""
    spark = rows.sparkSession
    n, sums, square = scatter(rows)
    trace = sum(square[i][i] for i in range(len(square)))
    if trace == 0:
        return Whitening(n, tuple(sums), (), (), np.zeros((len(sums), 0)))
    poly = characteristic(spark, square)
    zeros = next(i for i, c in enumerate(poly) if c)
    poly = poly[zeros:]
    count = min(most, len(poly) - 1)
    found = sorted(spark.range(1, count + 1, 1, count).select(F.col("id").cast("int").alias("component"))
                   .mapInArrow(partial(_components, square=square, poly=poly), "component int, value string, s int, vector array<double>").collect())
    exact = [Fraction(int(r.value), 1 << r.s) for r in found]
    return Whitening(n, tuple(sums), tuple(float(v / (n * n)) for v in exact), tuple(float(v / trace) for v in exact),
                     np.array([r.vector for r in found]).T)


def project(batch: pa.RecordBatch, model: Whitening) -> tuple[np.ndarray, list[int]]:
    """(whitened, deviations) of a batch: the differences n x - S are exact integers."""
    x = matrix(batch.column("_vector"))
    near = np.array([s // model.n for s in model.sums], np.int64)
    rest = [s - model.n * (s // model.n) for s in model.sums]
    z = x - near
    if (int(np.abs(z).max(initial=0)) + 1) * model.n < 1 << 62:
        far = z * model.n - np.array(rest, np.int64)
        small = int(np.abs(far).max(initial=0)) ** 2 * far.shape[1] < 1 << 63
        deviation = (far * far).sum(1).tolist() if small else (far.astype(object) ** 2).sum(1).tolist()
        centred = far / model.n
    else:
        far = z.astype(object) * model.n - np.array(rest, object)
        deviation = (far * far).sum(1).tolist()
        centred = np.array([[v / model.n for v in row] for row in far.tolist()], np.float64)
    return centred @ (model.vectors / np.sqrt(np.array(model.eigenvalues))), deviation


def _moments(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    """(i, j, v): sums of the products of whitened values; j = -1 has the sums of the values themselves."""
    k = len(model.eigenvalues)
    first, second = np.zeros(k), np.zeros((k, k))
    for batch in batches:
        values, _ = project(batch, model)
        first += values.sum(0)
        second += values.T @ values
    i, j = np.meshgrid(np.arange(k, dtype=np.int32), np.arange(-1, k, dtype=np.int32), indexing="ij")
    yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(np.c_[first, second].ravel())], ["i", "j", "v"])


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    k = len(model.eigenvalues)
    got = np.zeros((k, k + 1))
    for r in rows.mapInArrow(partial(_moments, model=model), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toLocalIterator():
        got[r.i, r.j + 1] = r.v / model.n
    mean, cross = got[:, 0], got[:, 1:]
    return float(np.abs(cross - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def _whitened(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            values, deviation = project(part, model)
            ends = pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*part.drop_columns(["_vector"]).columns, pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(values.ravel()))],
                [*part.drop_columns(["_vector"]).schema.names, "deviation", "_whitened"])


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = 32) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of every usable row and component.

    Rows drop out whose vector is null, empty, of an unusual length (see `scatter`) or holds null or non-finite entries.
    Entries become floor(64 c) + 1000000; floors beyond 2**62 count as 2**62. Repeated rows count and return each; a null
    key stays. Components with eigenvalue 0 are left out, so equal rows, one row or an empty table return nothing. A
    deviation beyond 63 bits is null. Other columns, whatever their names, are ignored.
    """
    rows = usable(vectors.select(F.col(key).alias("_key"), F.col(vector).alias("_given")), "_given")
    model = fit(rows, most)
    kind = rows.schema["_key"].dataType.simpleString()
    if not model.eigenvalues:
        return vectors.sparkSession.createDataFrame([], f"`{key}` {kind}, component int, n long, deviation long, whitened double, "
                                                        "explained double, identity_error double")
    same = rows.where(F.size("_vector") == len(model.sums))
    error = identity_error(same.select("_vector"), model)
    out = same.mapInArrow(partial(_whitened, model=model), f"_key {kind}, deviation long, _whitened array<double>")
    share = F.array(*map(F.lit, model.explained))
    return (out.select("_key", "deviation", F.posexplode("_whitened").alias("_k", "whitened"))
            .select(F.col("_key").alias(key), (F.col("_k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                    "whitened", F.get(share, F.col("_k")).alias("explained"), F.lit(error).alias("identity_error")))
