"""Whitening of embeddings through the exact characteristic polynomial of their scatter.

Vectors become integers, so their moments are integers and are summed exactly. The scatter ``n * sum(x
x') - S S'`` is n**2 times the covariance. Its characteristic polynomial is found modulo many primes
(similarity to Hessenberg form, then a recurrence), each task some primes, and put together by the
Chinese remainder theorem. All roots of the polynomial are real, so the sign changes of its shifted
coefficients count the roots above a point exactly: bisection isolates each root, repeated ones
included, to a hundred bits. Components come from the null space of the scatter less a root, by inverse
iteration with 80 digits.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from decimal import Context, Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a root that bisection settles, and digits of inverse iteration.
ROOT_BITS, DIGITS = 100, 80
#: A moment travels as limbs of so many bits, so that sums of limbs fit in 64 bits.
_LIMB_BITS, _LIMBS = 44, 5
_PRIMES_PER_TASK = 16
_EXACT_FLOAT, _LONG = 1 << 53, 1 << 63


class Whitener(NamedTuple):
    """Rows fitted on, sums of each dimension, and for each component its eigenvalue, its share of the
    total variance and its unit vector; the largest entry of the whitened covariance less the identity."""

    n: int
    sums: list[int]
    eigenvalues: list[float]
    shares: list[float]
    vectors: list[list[float]]
    error: float


def usable(column: str):
    """Whether a vector is there and holds neither nulls nor entries that are not finite."""
    c = F.col(f"`{column}`")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return c.isNotNull() & (F.size(c) > 0) & ~F.exists(c.cast("array<double>"), bad)


def _quantised(column: pa.Array, scale: float, offset: int) -> np.ndarray:
    """Rows of integers floor(scale * c) + offset; beyond 64 bits the nearest that fits."""
    values = column.values if not column.offset else column.flatten()
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and lengths.min() != lengths.max():
        raise ValueError("vectors of several lengths")
    wide = np.floor(values.to_numpy(zero_copy_only=False)[: int(lengths.sum())].astype(np.float64) * scale)
    whole = np.where(wide >= _LONG, _LONG - 1 - abs(offset), np.where(wide < -_LONG, -_LONG + abs(offset), 0)).astype(np.int64)
    inside = np.abs(wide) < _LONG - 2048
    whole[inside] = wide[inside].astype(np.int64)
    return whole.reshape(len(column), -1) + offset


def _moment(rows: np.ndarray) -> np.ndarray:
    """Exact products of the columns of integer rows, as Python integers where 64 bits do not do."""
    top = int(np.abs(rows).max(initial=0)) ** 2 * max(len(rows), 1)
    if top < _EXACT_FLOAT:
        wide = rows.astype(np.float64)
        return (wide.T @ wide).astype(np.int64).astype(object)
    if top < _LONG:
        return (rows.T @ rows).astype(object)
    return rows.astype(object).T @ rows.astype(object)


def moments(df: DataFrame, vector: str, scale: float, offset: int) -> tuple[int, list[int], list[list[int]]] | None:
    """Count, sums and products of the integer vectors, exactly. Each task sends one row for each pair of
    dimensions; none in all gives None."""
    schema = "i int, j int, d int, " + ", ".join(f"l{k} long" for k in range(_LIMBS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                rows = _quantised(batch.column(0).slice(low, 4096), scale, offset)
                # around the offset numbers are small; the caller's sums are moved back
                made = _moment(np.column_stack([np.ones(len(rows), np.int64), rows - offset]))
                if total is not None and made.shape != total.shape:
                    raise ValueError("vectors of several lengths")
                total = made if total is None else total + made
        if total is None:
            return
        i, j = np.triu_indices(len(total))
        values, mask, limbs = total[i, j], (1 << _LIMB_BITS) - 1, []
        for _ in range(_LIMBS - 1):
            limbs.append(pa.array((values & mask).tolist(), pa.int64()))
            values = values >> _LIMB_BITS
        limbs.append(pa.array(values.tolist(), pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([len(total)] * len(i), pa.int32()), *limbs],
            ["i", "j", "d", *[f"l{k}" for k in range(_LIMBS)]],
        )

    sums = [F.sum(f"l{k}").alias(f"l{k}") for k in range(_LIMBS)]
    found = df.select(F.col(f"`{vector}`")).mapInArrow(run, schema).groupBy("i", "j").agg(F.min("d").alias("low"), F.max("d").alias("high"), *sums).collect()
    if not found:
        return None
    size = max(r.high for r in found)
    if min(r.low for r in found) != size:
        raise ValueError("vectors of several lengths")
    m = [[0] * size for _ in range(size)]
    for r in found:
        m[r.i][r.j] = m[r.j][r.i] = sum(r[f"l{k}"] << _LIMB_BITS * k for k in range(_LIMBS))
    n, d = m[0][0], range(1, size)
    if n == 0:
        return None
    return n, [m[0][k] for k in d], [[m[a][b] for b in d] for a in d]


def _is_prime(n: int) -> bool:
    # These witnesses settle every number below 3,215,031,751.
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """The largest 31-bit primes whose product is over ``bound``."""
    out, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def _inverses(values: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Inverses modulo primes by Fermat's theorem; 0 for 0."""
    out, power, rest = np.ones_like(values), values % p, p - 2
    while rest.any():
        out = np.where(rest & 1, out * power % p, out)
        power, rest = power * power % p, rest >> 1
    return out * (values != 0)


def characteristic_residues(matrix: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """Coefficients of det(x I - A) for each prime, lowest first; ``matrix`` holds A modulo each prime."""
    a, p1 = matrix.copy(), primes.reshape(-1, 1)
    p2, every, d = p1[..., None], np.arange(len(primes)), matrix.shape[1]
    for k in range(d - 2):
        pivot = k + 1 + np.argmax(a[:, k + 1 :, k] != 0, axis=1)
        upper = a[:, k + 1].copy()
        a[:, k + 1], a[every, pivot] = a[every, pivot], upper
        side = a[:, :, k + 1].copy()
        a[:, :, k + 1], a[every, :, pivot] = a[every, :, pivot], side
        # rows below lose their entry in column k; columns take the reverse step
        factor = a[:, k + 2 :, k] * _inverses(a[:, k + 1, k], primes)[:, None] % p1
        a[:, k + 2 :] = (a[:, k + 2 :] - factor[:, :, None] * a[:, k + 1, None] % p2) % p2
        a[:, :, k + 1] = (a[:, :, k + 1] + (factor[:, None] * a[:, :, k + 2 :] % p2).sum(2)) % p1
    poly = np.zeros((len(primes), d + 1, d + 1), np.int64)
    poly[:, 0, 0] = 1
    for k in range(1, d + 1):
        poly[:, k, 1:] = poly[:, k - 1, :-1]
        poly[:, k] -= a[:, k - 1, k - 1, None] * poly[:, k - 1] % p1
        chain = np.ones(len(primes), np.int64)
        for i in range(k - 1, 0, -1):
            chain = chain * a[:, i, i - 1] % primes
            poly[:, k] -= (a[:, i - 1, k - 1] * chain % primes)[:, None] * poly[:, i - 1] % p1
        poly[:, k] %= p1
    return poly[:, d]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of det(x I - A), lowest first, of a positive semidefinite integer matrix.

    The coefficient of x**(d - k) is a sum of products of k eigenvalues, which Maclaurin's inequality
    bounds by binomial(d, k) * (trace / d)**k; the primes cover twice the largest bound."""
    d = len(matrix)
    mean = -(-sum(matrix[i][i] for i in range(d)) // d)
    primes = primes_for(2 * max(math.comb(d, k) * mean**k for k in range(d + 1)))
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(-(-len(primes) // _PRIMES_PER_TASK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(0).to_numpy()
            reduced = np.array([[[int(x % q) for x in row] for row in matrix] for q in p.tolist()], np.int64).reshape(len(p), d, d)
            residues = characteristic_residues(reduced, p)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(residues.tolist(), pa.list_(pa.int64()))], ["p", "residues"])

    found = {r.p: r.residues for r in rows.mapInArrow(run, "p long, residues array<long>").collect()}
    product = math.prod(primes)
    parts = [(p, product // p * pow(product // p, -1, p)) for p in primes]
    out = [sum(found[p][k] * part for p, part in parts) % product for k in range(d + 1)]
    return [x - product if x > product // 2 else x for x in out]


def roots_above(poly: list[int], numerator: int, bits: int) -> int:
    """How many roots, repeated ones counted, of a polynomial with real roots only are greater than
    numerator / 2**bits: the sign changes of its coefficients around that point."""
    d = len(poly) - 1
    c = [x << bits * (d - k) for k, x in enumerate(poly)]  # roots times 2**bits
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += numerator * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def largest_roots(poly: list[int], count: int) -> list[tuple[int, int]]:
    """The greatest positive roots in falling order, each as (numerator, bits): within 2**-bits of it, and
    to ``ROOT_BITS`` bits of its own. Repeated roots come repeatedly."""
    top = max(-poly[-2], 0)  # the trace
    if top == 0:
        return []
    positive = len(poly) - 1 - next(k for k, x in enumerate(poly) if x)
    wanted = min(count, positive)
    out: list[tuple[int, int]] = []
    # intervals (low, high] with the counts above their ends, greatest first
    open_ = [(0, 1 << top.bit_length(), 0, positive, 0)]
    while open_ and len(out) < wanted:
        low, high, bits, above_low, above_high = open_.pop()
        if above_low <= above_high or above_high >= wanted:
            continue
        if high - low == 1 and low.bit_length() >= ROOT_BITS:
            out += [(2 * low + 1, bits + 1)] * (above_low - above_high)
            continue
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        above = roots_above(poly, middle, bits)
        open_.append((low, middle, bits, above_low, above))
        open_.append((middle, high, bits, above, above_high))
    return out[:wanted]


def null_vectors(matrix: list[list[int]], roots: list[tuple[int, int]]) -> list[list[Decimal]]:
    """A unit vector for each root: inverse iteration on the matrix less the root, kept at right angles
    to the vectors of roots that agree with it in twenty digits."""
    context, d = Context(prec=DIGITS, Emin=-(10**9), Emax=10**9), len(matrix)
    plus, minus, times, over = context.add, context.subtract, context.multiply, context.divide
    rng, out, values = random.Random(1), [], []

    def dot(x: list[Decimal], y: list[Decimal]) -> Decimal:
        total = Decimal(0)
        for a, b in zip(x, y, strict=True):
            total = context.fma(a, b, total)
        return total

    for numerator, bits in roots:
        root = over(Decimal(numerator), Decimal(1 << bits))
        tiny = times(root, Decimal(10) ** -60)
        m = [[minus(Decimal(x), root) if i == j else context.plus(Decimal(x)) for j, x in enumerate(row)] for i, row in enumerate(matrix)]
        order, lower = list(range(d)), [[] for _ in range(d)]
        for k in range(d):
            best = max(range(k, d), key=lambda r: abs(m[r][k]))
            m[k], m[best], order[k], order[best], lower[k], lower[best] = m[best], m[k], order[best], order[k], lower[best], lower[k]
            if abs(m[k][k]) < tiny:
                m[k][k] = tiny
            for r in range(k + 1, d):
                f = over(m[r][k], m[k][k])
                lower[r].append(f)
                if f:
                    row, head = m[r], m[k]
                    for c in range(k + 1, d):
                        row[c] = minus(row[c], times(f, head[c]))
        close = [v for v, other in zip(out, values, strict=True) if abs(minus(other, root)) <= times(root, Decimal(10) ** -20)]
        x = [Decimal(rng.randrange(-(10**6), 10**6)) for _ in range(d)]
        for _ in range(4):
            y = [x[i] for i in order]
            for r in range(d):
                for c, f in enumerate(lower[r]):
                    y[r] = minus(y[r], times(f, y[c]))
            for r in range(d - 1, -1, -1):
                for c in range(r + 1, d):
                    y[r] = minus(y[r], times(m[r][c], y[c]))
                y[r] = over(y[r], m[r][r])
            for _ in range(2):
                for v in close:
                    share = dot(v, y)
                    y = [minus(a, times(share, b)) for a, b in zip(y, v, strict=True)]
                length = context.sqrt(dot(y, y))
                y = [over(a, length) for a in y]
            x = y
        out.append(x)
        values.append(root)
    return out


def fit(df: DataFrame, vector: str = "embedding", components: int = 8, scale: float = 1024.0, offset: int = 100_000) -> Whitener | None:
    """The leading components of the usable vectors; None where there are no such vectors.

    Only moments, of the size of the squared dimension, come to the driver. Components of variance 0 are
    left out: vectors that are all equal, or one alone, give none."""
    found = moments(df.filter(usable(vector)), vector, scale, offset)
    if found is None:
        return None
    n, moved, products = found
    d = range(len(moved))
    scatter = [[n * products[i][j] - moved[i] * moved[j] for j in d] for i in d]
    sums = [s + n * offset for s in moved]
    trace = sum(scatter[i][i] for i in d)
    if trace == 0:
        return Whitener(n, sums, [], [], [], 0.0)
    roots = largest_roots(characteristic_polynomial(df.sparkSession, scatter), components)
    exact = null_vectors(scatter, roots)
    context = Context(prec=DIGITS)
    values = [context.divide(Decimal(a), Decimal(1 << b)) for a, b in roots]
    vectors = [[float(x) for x in v] for v in exact]
    eigenvalues = [float(context.divide(v, Decimal(n) ** 2)) for v in values]
    # the covariance of what the rounded vectors and eigenvalues make of the data
    error = Decimal(0)
    scaled = [[context.multiply(Decimal(x), Decimal(n)) for x in v] for v in vectors]
    for a, u in enumerate(vectors):
        image = [sum(Decimal(x) * scatter[i][j] for i, x in enumerate(u)) for j in d]
        for b, v in enumerate(scaled):
            size = context.sqrt(Decimal(eigenvalues[a]) * Decimal(eigenvalues[b]))
            entry = context.divide(sum(context.multiply(x, y) for x, y in zip(image, v, strict=True)), size * Decimal(n) ** 3)
            error = max(error, abs(entry - (a == b)))
    return Whitener(n, sums, eigenvalues, [float(context.divide(v, Decimal(trace))) for v in values], vectors, float(error))


def whiten(df: DataFrame, model: Whitener | None, vector: str = "embedding", scale: float = 1024.0, offset: int = 100_000) -> DataFrame:
    """Add to each usable row ``n`` (rows fitted on), ``deviation`` (squared distance of n times its
    integers from the sums, exact, as a decimal of 38 digits; null beyond them) and ``whitened`` (one
    number for each component).

    Rows whose vector is null, empty or holds null or non-finite entries are left out; without a model
    or without components ``whitened`` is empty. Vectors of another length than those fitted raise.
    Repeated rows come repeatedly, other columns pass unchanged, and columns named like the new ones are
    replaced. Numbers beyond 64 bits count as the nearest that fits.
    """
    added = [T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    names = {f.name for f in added}
    kept = [f for f in df.schema.fields if f.name not in names]
    keep, at = [df.columns.index(f.name) for f in kept], df.columns.index(vector)
    schema = T.StructType([*kept, *added])
    if model is None:
        model = Whitener(0, [], [], [], [], 0.0)
    to_unit = np.array([[x / math.sqrt(e) for x in v] for v, e in zip(model.vectors, model.eigenvalues, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.array(model.sums, object)
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                rows = _quantised(part.column(at), scale, offset)
                if rows.shape[1] != len(sums):
                    raise ValueError("a vector of another length than those fitted")
                highest = model.n * int(np.abs(rows).max(initial=0)) + max(map(abs, model.sums))
                exact = rows.astype(object) if highest >= _LONG else rows
                centred = exact * model.n - (sums if highest >= _LONG else sums.astype(np.int64))
                wide = int(abs(centred).max()) ** 2 * len(sums) >= _LONG
                squares = (centred.astype(object) ** 2 if wide else centred**2).sum(axis=1).tolist()
                made = (centred.astype(np.float64) / model.n) @ to_unit.T if len(to_unit) else np.zeros((len(rows), 0))
                edge = np.arange(len(rows) + 1, dtype=np.int32) * made.shape[1]
                new = [
                    pa.array([model.n] * len(rows), pa.int64()),
                    pa.array([Decimal(x) if x < 10**38 else None for x in squares], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(pa.array(edge), pa.array(made.ravel(), pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in keep], *new], schema.names)

    return df.filter(usable(vector)).mapInArrow(run, schema)
