"""Embedding whitening from the exact characteristic polynomial of the integer scatter matrix.

Every entry ``c`` of a vector becomes the integer ``x = floor(64 c) + OFFSET``. The fit list is each
distinct x-vector once (``n`` of them, per-dimension sums ``S``). Spark computes, in exact integers,
the scatter ``M = n * sum(x x^T) - S S^T = n^2 V`` (``V`` the covariance over the fit list, divisor
``n``): each Arrow batch adds up ``y y^T`` with ``y = x - OFFSET`` (translation leaves ``M`` alone and
keeps the numbers small) and the partial sums meet in one aggregation of ``d (d + 1) / 2`` keys.

On the driver, which holds only ``d x d`` integers:

1. the characteristic polynomial of ``M`` modulo enough 31-bit primes (Hessenberg reduction and
   its recurrence, in numpy), joined by Chinese remaindering into exact integer coefficients;
2. its real roots isolated by exact signs at rational points between approximate eigenvalues,
   then bisected with exact integer arithmetic to ``ROOT_BITS`` bits;
3. each component by inverse iteration on ``M - lambda I``, whose null space it is, and
   orthogonalised against the components before it.

Rows are then projected in the JVM: ``whitened = (x - S/n) . u / sqrt(e)`` with ``e = lambda / n^2``.

Special rows: a null vector, or one with a null, NaN or infinite entry, is dropped. Vectors whose
length differs from the most common length among valid rows (ties: the longer) are dropped too.
Repeated vectors count once in the fit list and are all projected. Components of eigenvalue 0
have a null ``whitened``; ``explained`` is 0 there, and ``identity_error`` covers the others.
An empty table, or vectors of length 0, give no rows. Other columns pass through unless their
names clash with the ones added (or ``_y``, ``_c``, ``_p``, ``_w``, ``_component``, ``_whitened``),
which are dropped first.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OFFSET = 1_000_000
SCALE = 64
COMPONENTS = 16
ROOT_BITS = 120
PRIME_TOP = (1 << 31) - 1

_INTERNAL = ["_y", "_c", "_p", "_w", "_component", "_whitened"]
_MOMENTS = "i int, j int, value decimal(38,0)"
_FLOAT_MOMENTS = "i int, j int, value double"


def _valid(vec):
    finite = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return vec.isNotNull() & finite


def integer_vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Valid rows with ``y = floor(64 c)`` (long entries; ``x = y + OFFSET``), as column ``_y``."""
    vec = F.col(column).cast("array<double>")
    valid = df.where(_valid(vec)).withColumn("_y", F.transform(vec, lambda c: F.floor(c * SCALE)))
    lengths = valid.groupBy(F.size("_y").alias("_d")).count()
    top = lengths.orderBy(F.desc("count"), F.desc("_d")).limit(1).collect()
    if not top:
        return valid
    return valid.where(F.size("_y") == top[0]["_d"])


def _batch_moments(exact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums, count = None, None, 0
        for batch in batches:
            column = batch.column(0)
            if len(column) == 0:
                continue
            d = len(column[0])
            flat = column.flatten().to_numpy(zero_copy_only=False)
            y = flat.reshape(len(column), d)
            if exact:
                y = y.astype(np.int64)
                peak = int(np.abs(y).max(initial=0))
                if peak * peak * len(y) < (1 << 62):
                    part, s = (y.T @ y).astype(object), y.sum(axis=0).astype(object)
                else:  # exact beyond 64 bits, for very large entries
                    obj = y.astype(object)
                    part, s = obj.T.dot(obj), obj.sum(axis=0)
            else:
                y = y.astype(np.float64)
                part, s = y.T @ y, y.sum(axis=0)
            total = part if total is None else total + part
            sums = s if sums is None else sums + s
            count += len(y)
        if total is None:
            return
        d = len(sums)
        i, j = np.triu_indices(d)
        rows_i = [*i.tolist(), *range(d), -1]
        rows_j = [*j.tolist(), *([-1] * d), -1]
        values = [*total[i, j].tolist(), *sums.tolist(), count]
        if exact:
            from decimal import Decimal

            array = pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))
        else:
            array = pa.array([float(v) for v in values], pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(rows_i, pa.int32()), pa.array(rows_j, pa.int32()), array], ["i", "j", "value"])

    return run


def moments(df: DataFrame, column: str, exact: bool = True) -> tuple[int, list, list[list]]:
    """(n, S, sum of outer products) of an array column, summed in Spark; only d^2 numbers come back."""
    schema = _MOMENTS if exact else _FLOAT_MOMENTS
    parts = df.select(column).mapInArrow(_batch_moments(exact), schema)
    rows = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    conv = (lambda v: int(v)) if exact else float
    n, sums, pairs = 0, {}, {}
    for r in rows:
        if r["i"] == -1:
            n = conv(r["value"])
        elif r["j"] == -1:
            sums[r["i"]] = conv(r["value"])
        else:
            pairs[(r["i"], r["j"])] = conv(r["value"])
    d = len(sums)
    outer = [[pairs[(min(a, b), max(a, b))] for b in range(d)] for a in range(d)]
    return n, [sums[a] for a in range(d)], outer


# ---- exact characteristic polynomial --------------------------------------------------------


def _is_prime(p: int) -> bool:
    if p < 2 or p % 2 == 0:
        return p == 2
    d, s = p - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7, 11, 13, 17):
        if a % p == 0:
            continue
        x = pow(a, d, p)
        if x in (1, p - 1):
            continue
        for _ in range(s - 1):
            x = x * x % p
            if x == p - 1:
                break
        else:
            return False
    return True


def _primes(count: int) -> list[int]:
    found, p = [], PRIME_TOP
    while len(found) < count:
        if _is_prime(p):
            found.append(p)
        p -= 2
    return found


def _charpoly_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients (constant first) of det(t I - A) mod p, by Hessenberg reduction."""
    h = a.copy() % p
    d = len(h)
    for m in range(1, d - 1):
        nonzero = np.nonzero(h[m:, m - 1])[0]
        if len(nonzero) == 0:
            continue
        i = m + int(nonzero[0])
        if i != m:
            h[[i, m], :] = h[[m, i], :]
            h[:, [i, m]] = h[:, [m, i]]
        inverse = pow(int(h[m, m - 1]), p - 2, p)
        u = h[m + 1 :, m - 1] * inverse % p
        if not u.any():
            continue
        h[m + 1 :, :] = (h[m + 1 :, :] - (u[:, None] * h[m, :][None, :]) % p) % p
        h[:, m] = (h[:, m] + ((h[:, m + 1 :] * u[None, :]) % p).sum(axis=1)) % p
    polys = [np.zeros(d + 1, np.int64)]
    polys[0][0] = 1
    for k in range(1, d + 1):
        prev = polys[k - 1]
        cur = np.zeros(d + 1, np.int64)
        cur[1:] = prev[:-1]
        cur = (cur - h[k - 1, k - 1] * prev % p) % p
        t = 1
        for i in range(k - 1, 0, -1):
            t = t * int(h[i, i - 1]) % p
            coef = t * int(h[i - 1, k - 1]) % p
            if coef:
                cur = (cur - coef * polys[i - 1] % p) % p
        polys.append(cur)
    return polys[d]


def charpoly(m: list[list[int]]) -> list[int]:
    """Exact integer coefficients (constant first) of det(t I - M)."""
    d = len(m)
    if d == 0:
        return [1]
    peak = max(1, max(abs(v) for row in m for v in row))
    # |c_k| <= C(d, k) (sqrt(k) peak)^k (Hadamard); twice the largest, plus a margin
    bound = max(_binomial(d, k) * _isqrt_up(k**k) * peak**k for k in range(d + 1))
    primes, product = [], 1
    for p in _primes(4 * d + 8):
        if product > 4 * bound:
            break
        primes.append(p)
        product *= p
    while product <= 4 * bound:
        more = _primes(len(primes) * 2)[len(primes) :]
        for p in more:
            primes.append(p)
            product *= p
    residues = [_charpoly_mod(np.array([[v % p for v in row] for row in m], np.int64), p) for p in primes]
    coefficients = []
    for k in range(d + 1):
        value, modulus = 0, 1
        for p, r in zip(primes, residues):
            # value := the number congruent to value mod modulus and to r[k] mod p
            step = (int(r[k]) - value) * pow(modulus, -1, p) % p
            value += modulus * step
            modulus *= p
        coefficients.append(value - modulus if value > modulus // 2 else value)
    return coefficients


def _binomial(n: int, k: int) -> int:
    from math import comb

    return comb(n, k)


def _isqrt_up(v: int) -> int:
    from math import isqrt

    r = isqrt(v)
    return r if r * r == v else r + 1


# ---- real roots -----------------------------------------------------------------------------


def _sign_at(coefficients: list[int], num: int, shift: int) -> int:
    """Sign of P(num / 2^shift), exactly."""
    d = len(coefficients) - 1
    value = 0
    for k in range(d, -1, -1):
        value = value * num + (coefficients[k] << (shift * (d - k)))
    return (value > 0) - (value < 0)


def roots(coefficients: list[int], approximate: list[float]) -> list[Fraction]:
    """All real roots (with multiplicity) of a polynomial whose roots are all real, largest first.

    Roots are isolated by exact signs at points between the sorted approximations, then bisected to
    ``ROOT_BITS`` bits. Clusters that no sign change separates keep the approximations given.
    """
    d = len(coefficients) - 1
    if d == 0:
        return []
    approx = sorted(approximate, reverse=True)
    top = max(abs(c) for c in coefficients) // max(1, abs(coefficients[-1])) + 1
    shift = ROOT_BITS
    unit = 1 << shift
    cuts = [top * unit + unit]
    for a, b in zip(approx, approx[1:]):
        cuts.append(int((a + b) / 2 * unit))
    cuts.append(-unit)
    signs = [_sign_at(coefficients, c, shift) for c in cuts]
    found = []
    for k in range(d):
        hi, lo = cuts[k], cuts[k + 1]
        s_hi, s_lo = signs[k], signs[k + 1]
        if s_hi == 0:
            found.append(Fraction(hi, unit))
            continue
        if s_lo == 0 or s_hi == s_lo or hi <= lo:
            found.append(Fraction(approx[k]).limit_denominator(unit))
            continue
        # a narrow bracket around the approximation, when exact signs confirm it
        guess, width = int(approx[k] * unit), int(abs(approx[k]) * 1e-11 * unit) + 1
        if lo < guess - width and guess + width < hi:
            s_a, s_b = _sign_at(coefficients, guess - width, shift), _sign_at(coefficients, guess + width, shift)
            if s_a == s_lo and s_b == s_hi:
                lo, hi = guess - width, guess + width
        while hi - lo > 1 and (hi - lo) > (abs(hi) >> (ROOT_BITS // 2)):
            mid = (hi + lo) // 2
            s_mid = _sign_at(coefficients, mid, shift)
            if s_mid == 0:
                hi = lo = mid
                break
            if s_mid == s_hi:
                hi = mid
            else:
                lo = mid
        found.append(Fraction(hi + lo, 2 * unit))
    return found


# ---- components -----------------------------------------------------------------------------


def components(m: list[list[int]], count: int = COMPONENTS) -> tuple[list[Fraction], np.ndarray]:
    """Eigenvalues of M (largest first, exact polynomial roots) and the first ``count`` unit eigenvectors.

    Each vector is the null space of ``M - lambda I``, found by inverse iteration; it is orthogonalised
    against those before it and signed so that its largest entry (first of ties) is positive.
    """
    d = len(m)
    if d == 0:
        return [], np.zeros((0, 0))
    peak = max(1, max(abs(v) for row in m for v in row))
    scaled = np.array([[v / peak for v in row] for row in m], np.float64)
    approx = [float(v) * peak for v in np.linalg.eigvalsh(scaled)]
    poly = charpoly(m)
    zeros = next(k for k, c in enumerate(poly) if c != 0)  # exact multiplicity of the root 0
    values = roots(poly[zeros:], sorted(approx, reverse=True)[: d - zeros]) + [Fraction(0)] * zeros
    values = [max(v, Fraction(0)) for v in values]
    vectors = []
    for k in range(min(count, d)):
        lam = values[k]
        shifted = np.array([[float(Fraction(m[a][b]) - (lam if a == b else 0)) / peak for b in range(d)] for a in range(d)])
        shifted += np.eye(d) * (np.finfo(float).eps * 4)
        v = np.random.default_rng(k).standard_normal(d)
        for _ in range(4):
            for u in vectors:
                v -= (u @ v) * u
            try:
                v = np.linalg.solve(shifted, v)
            except np.linalg.LinAlgError:
                v = np.linalg.lstsq(shifted, v, rcond=None)[0]
            for u in vectors:
                v -= (u @ v) * u
            v /= np.linalg.norm(v)
        big = int(np.argmax(np.abs(v) - 1e-12 * np.arange(d)))
        vectors.append(v if v[big] > 0 else -v)
    return values, np.array(vectors)


def whiten(df: DataFrame, column: str = "embedding", key: str = "vec_id", count: int = COMPONENTS) -> DataFrame:
    """Rows of ``key, component, n, deviation, whitened, explained, identity_error`` (one per valid
    row and component), and the other columns of ``df``."""
    added = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = integer_vectors(df.drop(*[c for c in [*added, *_INTERNAL] if c not in (column, key)]), column)
    fit = rows.select("_y").dropDuplicates(["_y"])
    n, sums, outer = moments(fit, "_y", exact=True)
    d = len(sums)
    if n == 0 or d == 0:
        return rows.select(*[c for c in rows.columns if c != "_y"], *[F.lit(None).alias(c) for c in added]).where(F.lit(False))
    scatter = [[n * outer[a][b] - sums[a] * sums[b] for b in range(d)] for a in range(d)]
    values, vectors = components(scatter, count)
    n2 = n * n
    trace = sum(scatter[a][a] for a in range(d))
    mean = [s / n for s in sums]
    kept = len(vectors)
    eig = [float(values[k] / n2) for k in range(kept)]
    explained = [float(values[k] / trace) if trace else 0.0 for k in range(kept)]
    centred = F.zip_with("_y", F.array(*[F.lit(v) for v in mean]), lambda a, b: a.cast("double") - b)

    def project(k: int):
        if eig[k] <= 0:
            return F.lit(None).cast("double")
        weights = F.array(*[F.lit(float(w) / eig[k] ** 0.5) for w in vectors[k]])
        return F.aggregate(F.zip_with("_c", weights, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)

    deviation = F.aggregate(
        F.zip_with("_y", F.array(*[F.lit(s) for s in sums]), lambda a, s: F.lit(n) * a - s),
        F.lit(0).cast("bigint"),
        lambda acc, v: acc + v * v,
    )
    parts = F.array(*[F.struct(F.lit(k + 1).alias("_component"), project(k).alias("_whitened")) for k in range(kept)])
    projected = rows.withColumn("_c", centred).withColumn("deviation", deviation).withColumn("_p", parts)
    error = _identity_error(fit.withColumn("_c", centred).select(F.transform(parts, lambda p: p["_whitened"]).alias("_w")), eig)
    return projected.select("*", F.inline("_p")).select(
        *[c for c in rows.columns if c != "_y"],
        F.col("_component").alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        F.col("_whitened").alias("whitened"),
        F.array(*[F.lit(v) for v in explained])[F.col("_component") - 1].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _identity_error(whitened: DataFrame, eig: list[float]) -> float:
    """Largest |cov(w) - I| over the fit list (divisor n), of components with a positive eigenvalue."""
    usable = [k for k, e in enumerate(eig) if e > 0]
    if not usable:
        return 0.0
    picked = whitened.select(F.array(*[F.col("_w")[k] for k in usable]).alias("_w"))
    n, sums, outer = moments(picked, "_w", exact=False)
    mean = np.array(sums) / n
    cov = np.array(outer) / n - np.outer(mean, mean)
    return float(np.abs(cov - np.eye(len(usable))).max())


__all__ = ["charpoly", "components", "integer_vectors", "moments", "roots", "whiten"]
