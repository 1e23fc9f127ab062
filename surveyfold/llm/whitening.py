"""Embedding whitening from the exact characteristic polynomial of the scatter.

Entries become integers, and the fit list is each distinct integer vector once.
Tasks add up its sums and products exactly, so the scatter ``M = n * sum(x x') -
S S'`` (n squared times the covariance) is an exact integer matrix, whatever the
partitioning. A shift of all entries by a constant leaves M as it is, so the
work is on ``floor(64 c)`` without the offset.

*Polynomial.* Its characteristic polynomial has integer coefficients. Every
prime is one row of a Spark job: M modulo the prime goes to Hessenberg form and
gives the coefficients modulo the prime. Chinese remaindering joins as many
primes as the coefficients' bound needs.

*Roots.* All roots are real, so Descartes' rule is exact: the number of roots
above ``a``, repeats counted, is the number of sign changes of ``p(x + a)``.
Bisection on integers at a scale of ``2 ** s`` isolates each root and goes on to
about ``ROOT_BITS`` bits below the trace; roots that do not part by then are one
root of that multiplicity.

*Components.* A component is the null space of ``M - root``: elimination and two
steps of inverse iteration in ``DIGITS`` decimal digits, several starts made
orthogonal where the root is repeated. Every component is a row of a Spark job
that does its own root and null space. What the driver holds is bounded by the
vectors' length, never by the rows.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage_table
from .common import bound_batches, shuffle_partitions, tidy

SCALE, COMPONENTS = 64, 16
ROOT_BITS, DIGITS = 192, 140
LONG = (1 << 63) - 1
CHUNK = 4096                 # rows whose products are exact in float64 while entries are under SMALL
SMALL = 1 << 20
LIMB = 48                    # exact sums travel as two decimals, split at this bit


# --- integers ----------------------------------------------------------------

def integer_entries(col: str) -> Column:
    """floor(64 c) as long (beyond 64 bits the nearest); null where the vector or an entry is null or not finite."""
    x = lambda v: v.cast("double")
    fine = F.forall(col, lambda v: v.isNotNull() & ~F.isnan(x(v)) & (F.abs(x(v)) < float("inf")))
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(col, lambda v: F.greatest(F.floor(x(v) * SCALE), F.lit(-LONG))))


def exact_products(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, products) of integer rows as Python integers."""
    d = rows.shape[1]
    sums, products = np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)
    for at in range(0, len(rows), CHUNK):
        part = rows[at:at + CHUNK]
        if np.abs(part).max(initial=0) < SMALL:
            x = part.astype(np.float64)
            sums += part.sum(axis=0).astype(object)
            products += (x.T @ x).astype(np.int64).astype(object)
        else:
            x = part.astype(object)
            sums += x.sum(axis=0)
            products += x.T @ x
    return sums, products


def scatter(fit: DataFrame, dims: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sums, M) of the fit list; d (d + 3) / 2 exact sums reach the driver."""
    cells = [(-1, i) for i in range(dims)] + [(i, j) for i in range(dims) for j in range(i, dims)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, sums, products = 0, np.zeros(dims, dtype=object), np.zeros((dims, dims), dtype=object)
        for f in batches:
            if len(f):
                n += len(f)
                more = exact_products(np.stack(f.y.tolist()))
                sums, products = sums + more[0], products + more[1]
        if n:
            values = [n, *(sums[j] if i < 0 else products[i, j] for i, j in cells)]
            yield pd.DataFrame({"cell": np.arange(-1, len(cells)), "low": [str(int(v) & ((1 << LIMB) - 1)) for v in values],
                                "high": [str(int(v) >> LIMB) for v in values]})

    parts = fit.mapInPandas(run, "cell long, low string, high string")
    whole = "decimal(38,0)"
    got = {r.cell: (int(r.high) << LIMB) + int(r.low) for r in parts.groupBy("cell").agg(
        F.sum(F.col("low").cast(whole)).alias("low"), F.sum(F.col("high").cast(whole)).alias("high")).collect()}
    n, sums, m = got.get(-1, 0), np.zeros(dims, dtype=object), np.zeros((dims, dims), dtype=object)
    for k, (i, j) in enumerate(cells):
        if i < 0:
            sums[j] = got.get(k, 0)
        else:
            m[i, j] = m[j, i] = got.get(k, 0)
    return n, sums, n * m - np.outer(sums, sums)


# --- the characteristic polynomial -------------------------------------------

def is_prime(n: int) -> bool:
    """Miller-Rabin; the bases decide every 32-bit number."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(m: np.ndarray) -> list[int]:
    """Primes under 2 ** 31 whose product passes twice every coefficient's bound.

    M has no negative root, so the coefficients add up, in size, to the product
    of (1 + root), which is at most (1 + trace / d) ** d.
    """
    d, trace = len(m), int(np.trace(m))
    bits = d * math.log2(1 + -(-trace // d)) + 2 if d else 2
    out, n = [], (1 << 31) - 1
    while len(out) * 30.99 < bits:
        if is_prime(n):
            out.append(n)
        n -= 2
    return out


def polynomial_mod(m: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - M) modulo p, the constant first, by Hessenberg form."""
    d = len(m)
    h = (m % p).astype(np.int64)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        r = k + int(below[0])
        if r != k:
            h[[r, k]] = h[[k, r]]
            h[:, [r, k]] = h[:, [k, r]]
        f = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - f[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1:] * f % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), dtype=np.int64)             # of the leading blocks
    polys[0, 0] = 1
    for k in range(1, d + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - h[k - 1, k - 1] * polys[k - 1] % p) % p
        chain = 1
        for i in range(k - 1, 0, -1):
            chain = chain * int(h[i, i - 1]) % p
            if not chain:
                break
            polys[k] = (polys[k] - int(h[i - 1, k - 1]) * chain % p * polys[i - 1] % p) % p
    return polys[d].tolist()


def remaindered(residues: list[tuple[int, list[int]]]) -> list[int]:
    """The integers, positive or negative, with these residues."""
    out, modulus = [0] * len(residues[0][1]), 1
    for p, values in sorted(residues):
        inverse = pow(modulus % p, -1, p)
        out = [x + modulus * ((v - x) * inverse % p) for x, v in zip(out, values, strict=True)]
        modulus *= p
    return [x - modulus if 2 * x > modulus else x for x in out]


def characteristic_polynomial(spark, m: np.ndarray) -> list[int]:
    primes = primes_for(m)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            yield pd.DataFrame({"p": f.p, "values": [polynomial_mod(m, p) for p in f.p.tolist()]})

    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), shuffle_partitions(spark)))
    return remaindered([(r.p, r["values"]) for r in rows.mapInPandas(run, "p long, values array<long>").collect()])


# --- roots -------------------------------------------------------------------

def scaled(poly: list[int], s: int) -> list[int]:
    """The polynomial whose roots are 2 ** s times as large."""
    d = len(poly) - 1
    return [c << s * (d - k) for k, c in enumerate(poly)]


def roots_above(poly: list[int], a: int) -> int:
    """How many roots, repeats counted, lie above ``a`` (all roots real)."""
    c = list(poly)
    for stop in range(len(c) - 1):
        for k in range(len(c) - 2, stop - 1, -1):
            c[k] += a * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def value_at(poly: list[int], a: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * a + c
    return out


def root(poly: list[int], number: int, top: int) -> tuple[int, int, int]:
    """(a, first, last): the ``number``-th largest root lies in (a, a + 1], as do the first to the last.

    ``top``: no root is larger. Between two bounds with one root, signs suffice.
    """
    low, high, above_low, above_high = 0, top, roots_above(poly, 0), 0
    while high - low > 1:
        mid = (low + high) // 2
        if above_low - above_high == 1:
            value = value_at(poly, mid)
            above = above_high if value == 0 else above_low if (value > 0) == (above_low % 2 == 0) else above_high
        else:
            above = roots_above(poly, mid)
        if above >= number:
            low, above_low = mid, above
        else:
            high, above_high = mid, above
    return low, above_high + 1, above_low


# --- null spaces -------------------------------------------------------------

def null_space(m: np.ndarray, value: decimal.Decimal, width: int) -> np.ndarray:
    """(width, d) orthonormal rows that span the null space of M - value, by inverse iteration.

    Each row's sign: its largest entry, the first of equals, is positive.
    """
    d = len(m)
    with decimal.localcontext(prec=DIGITS):
        a = np.array([[decimal.Decimal(int(x)) for x in row] for row in m], dtype=object).reshape(d, d)
        a[np.diag_indices(d)] -= value
        least = decimal.Decimal(10) ** (decimal.Decimal(max(1, int(np.trace(m)))).adjusted() - DIGITS)
        order = np.arange(d)
        for k in range(d):
            r = k + int(np.argmax(np.abs(a[k:, k])))
            a[[k, r]], order[[k, r]] = a[[r, k]], order[[r, k]]
            if abs(a[k, k]) < least:
                a[k, k] = least
            a[k + 1:, k] = a[k + 1:, k] / a[k, k]
            a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])

        def solve(b: np.ndarray) -> np.ndarray:
            x = b[order].copy()
            for k in range(d):
                x[k + 1:] -= a[k + 1:, k] * x[k]
            for k in range(d - 1, -1, -1):
                x[k] = x[k] / a[k, k]
                x[:k] -= a[:k, k] * x[k]
            return x

        start = np.random.default_rng(1).integers(1, 1000, (width, d))
        basis = [np.array([decimal.Decimal(int(x)) for x in row], dtype=object) for row in start]
        for _ in range(3):
            done: list[np.ndarray] = []
            for x in basis:
                x = solve(x)
                for _ in range(2):
                    x = x / (x * x).sum().sqrt()
                    for y in done:
                        x = x - y * (x * y).sum()
                done.append(x / (x * x).sum().sqrt())
            basis = done
        out = np.array([[float(v) for v in x] for x in basis]).reshape(width, d)
    lead = np.abs(out).argmax(axis=1)
    return out * np.where(out[np.arange(width), lead] < 0, -1, 1)[:, None]


def components(spark, m: np.ndarray, most: int = COMPONENTS) -> list[tuple[float, float, np.ndarray]]:
    """(root of M's square root, share of the trace, unit vector) of the largest positive roots."""
    poly, trace = characteristic_polynomial(spark, m), int(np.trace(m))
    s = max(0, ROOT_BITS - trace.bit_length())
    count = min(most, roots_above(poly, 0))
    if not count:
        return []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fine = scaled(poly, s)
        for f in batches:
            for number in f.number.tolist():
                a, first, last = root(fine, number, trace << s)
                with decimal.localcontext(prec=DIGITS):
                    value = decimal.Decimal(2 * a + 1) / (1 << s + 1)
                    if value_at(fine, a + 1) == 0:
                        value = decimal.Decimal(a + 1) / (1 << s)
                    told = float(value.sqrt()), float(value / trace)
                vector = null_space(m, value, last - first + 1)[number - first]
                yield pd.DataFrame({"number": [number], "size": [told[0]], "share": [told[1]], "vector": [vector]})

    rows = spark.createDataFrame([(k + 1,) for k in range(count)], "number int").repartition(count, "number")
    found = rows.mapInPandas(run, "number int, size double, share double, vector array<double>").collect()
    return [(r["size"], r["share"], np.array(r.vector)) for r in sorted(found)]


# --- on Spark ----------------------------------------------------------------

def deviations(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact: 64-bit where they fit, Python integers elsewhere."""
    most = n * (int(np.abs(rows).max(initial=0)) + 1) + max((abs(int(x)) for x in sums), default=0)
    if most < LONG:
        return n * rows - sums.astype(np.int64)
    return n * rows.astype(object) - sums


def identity_error(fit: DataFrame, project, count: int, n: int) -> float:
    """Largest entry of whitened's covariance minus the identity, over the fit list."""
    def added(per_batch, width: int) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(width)
            for f in batches:
                if len(f):
                    total += per_batch(project(np.stack(f.y.tolist()))[0])
            yield pd.DataFrame({"at": np.arange(width), "value": total})
        parts = fit.mapInPandas(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toPandas()
        return parts.sort_values("at")["value"].to_numpy() / n

    mean = added(lambda z: z.sum(axis=0), count)
    covariance = added(lambda z: ((z - mean).T @ (z - mean)).ravel(), count * count).reshape(count, count)
    return float(np.abs(covariance - np.eye(count)).max())


def whiten(table: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error per row and component.

    Rows with a null vector or a null or non-finite entry are dropped; a null or
    repeated id is no reason to drop a row. Equal vectors count once in the fit.
    Vectors of different lengths are fitted apart. A covariance of lower rank
    than ``most`` has as many components as its rank, so a single distinct
    vector gives no rows. Equal eigenvalues: one orthonormal basis for all rows.
    A component's largest entry is positive. A deviation beyond 64 bits is null.
    Empty in, empty out; other columns are not read.
    """
    spark = table.sparkSession
    bound_batches(spark)
    schema = T.StructType([
        T.StructField("vec_id", table.schema[id_col].dataType), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    rows = stage_table(table.select(F.col(id_col).alias("vec_id"), integer_entries(vector_col).alias("y"))
                       .filter("y is not null"), "whitening-rows")
    fits = stage_table(rows.select("y").distinct(), "whitening-fit")
    out = spark.createDataFrame([], schema)
    for length in sorted(r.d for r in fits.select(F.size("y").alias("d")).distinct().collect()):   # one as a rule
        own, fit = (df.filter(F.size("y") == length) for df in (rows, fits))
        out = out.unionByName(_whitened(own, fit, length, most, schema))
    return out


def _whitened(rows: DataFrame, fit: DataFrame, length: int, most: int, schema: T.StructType) -> DataFrame:
    spark = rows.sparkSession
    n, sums, m = scatter(fit, length)
    found = components(spark, m, most)
    if not found:
        return spark.createDataFrame([], schema)
    k, sizes, shares = len(found), np.array([c[0] for c in found]), np.array([c[1] for c in found])
    vectors = np.stack([c[2] for c in found], axis=1)

    def project(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        away = deviations(y, n, sums)                            # n (x - S / n); the root of M is n times that of V
        return away.astype(np.float64) @ vectors / sizes, away

    error = identity_error(fit, project, k, n)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            y = batch.column(1).flatten().to_numpy().reshape(count, length)
            z, away = project(y)
            if float(np.abs(away).max()) ** 2 * length < 2.0 ** 62:
                square = pa.array((away.astype(np.int64) ** 2).sum(axis=1))
            else:
                exact = [sum(int(v) ** 2 for v in row) for row in away]
                square = pa.array([v if v <= LONG else None for v in exact], pa.int64())
            each = pa.array(np.repeat(np.arange(count), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1), count), pa.int32()),
                 pa.array(np.full(count * k, n), pa.int64()), square.take(each), pa.array(z.ravel()),
                 pa.array(np.tile(shares, count)), pa.array(np.full(count * k, error))], names=schema.names)

    return rows.select("vec_id", "y").mapInArrow(run, schema)
