"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter.

1. Entries become integers x. Their number n, sums S and scatter n * sum(x x') - S S' = n**2 * covariance are exact: tasks
   centre by the rounded mean, cut the differences into limbs of 20 bits, whose products doubles hold exactly, and the
   limbs' sums are added as decimals.
2. Characteristic polynomial: modulo each of enough primes, tasks reduce the scatter to Hessenberg form and expand the
   polynomial by its recurrence; the residues meet by Chinese remaindering. Coefficients are bounded by Maclaurin's
   inequality, since no eigenvalue is negative.
3. All roots are real, so the sign changes of the shifted polynomial count the roots above a point, multiple ones
   included. Bisection with exact integers isolates the largest roots, signs refine single ones to PRECISION bits.
4. For each root, a task finds the null space of scatter - root by inverse iteration in fixed point; equal roots get an
   orthonormal basis.
5. One more pass projects the rows. The covariance of what came out is measured over all rows, centred first.

The driver holds d * d sums and d coefficients for each prime, whatever the number of rows.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped; empty vectors have no
components; vectors of another length are a fit list of their own; rows with null or repeated ids are rows each;
components whose eigenvalue is zero cannot be scaled and are left out, so vectors that are all equal give no row; entries
beyond 64 bits are the nearest long, and so are deviations; where entries differ by more than some 2**50 in size, small
components are rounded in their projections, which identity_error shows; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmarket.llm.common import result, scratch, table, written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Bits of a limb, and rows of a product, so that sums of products stay below 2**53.
LIMB, ROWS = 20, 4096
#: Bits of a root, and bits after the point of the null spaces.
PRECISION, POINT = 128, 320
PRIMES_A_TASK = 8
MOST = (1 << 63) - 1


def integers(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, dim, x array<long>) of the vectors that take part."""
    v = F.col(f"`{vector}`")
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(c))
    x = F.transform(v, lambda c: F.least(F.floor(c.cast("double") * SCALE).cast("long"), F.lit(MOST - SHIFT)) + SHIFT)
    return vectors.filter(sound).select(F.col("vec_id").cast("long").alias("vec_id"), F.size(v).alias("dim"), x.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """Runs of at most ROWS rows of one length, as matrices."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            own = batch.take(pa.array(np.flatnonzero(dims == dim)))
            for i in range(0, own.num_rows, ROWS):
                part = own.slice(i, ROWS)
                yield int(dim), part, part.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, int(dim))


def sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per length, the number of rows and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, _, m in _matrices(batches):
            high, low = (m >> 32).sum(axis=0), (m & 0xFFFFFFFF).sum(axis=0)
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim] * dim, pa.int32()), "i": pa.array(range(dim), pa.int32()), "n": pa.array([len(m)] * dim, pa.int64()), "high": high, "low": low})

    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    parts = rows.mapInArrow(add, "dim int, i int, n long, high long, low long").groupBy("dim", "i").agg(F.sum("n").alias("n"), total("high"), total("low"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(parts.collect(), key=lambda r: (r["dim"], r["i"])):
        out.setdefault(r["dim"], (r["n"], []))[1].append((int(r["high"]) << 32) + int(r["low"]))
    return out


def centred(m: np.ndarray, centre: list[int]) -> np.ndarray:
    """m minus whole numbers; as Python integers where longs could overflow."""
    c = np.array(centre, dtype=np.int64)
    wide = max(int(m.max(initial=0)), -int(m.min(initial=0)), int(c.max(initial=0)), -int(c.min(initial=0))) >= 1 << 62
    return m.astype(object) - c.astype(object) if wide else m - c


def limbs_of(d: np.ndarray) -> list[np.ndarray]:
    """d as a sum of limb * 2**(LIMB * place), as doubles; limbs are below 2**LIMB in size, the last one signed."""
    out = []
    while True:
        if not d.size or max(abs(int(d.max())), abs(int(d.min()))) < 1 << LIMB:
            return [*out, d.astype(np.float64)]
        out.append((d & ((1 << LIMB) - 1)).astype(np.float64))
        d = d >> LIMB


def scatters(rows: DataFrame, means: dict[int, list[int]]) -> dict[int, list[list[int]]]:
    """Per length, the exact sum of products of all pairs of dimensions, centred by whole numbers."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for dim, _, m in _matrices(batches):
            limbs = limbs_of(centred(m, means[dim]))
            for a, x in enumerate(limbs):
                for b, y in enumerate(limbs):
                    held[dim, a + b] = held.get((dim, a + b), 0) + (x.T @ y).astype(np.int64).astype(object)
        for (dim, place), s in held.items():
            i, j = np.triu_indices(dim)
            values = pa.array([Decimal(int(v)) for v in s[i, j]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim] * len(i), pa.int32()), "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "place": pa.array([place] * len(i), pa.int32()), "s": values})

    out = {dim: [[0] * dim for _ in range(dim)] for dim in means}
    for r in rows.mapInArrow(add, "dim int, i int, j int, place int, s decimal(38,0)").groupBy("dim", "i", "j", "place").agg(F.sum("s").alias("s")).collect():
        v = int(r["s"]) << (LIMB * r["place"])
        out[r["dim"]][r["i"]][r["j"]] += v
        if r["i"] != r["j"]:
            out[r["dim"]][r["j"]][r["i"]] += v
    return out


# --- characteristic polynomial --------------------------------------------------------------------------------------


def _is_prime(n: int) -> bool:
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):  # enough below 3,215,031,751
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes(bits: int) -> list[int]:
    """The largest primes below 2**31 whose product has more than so many bits."""
    out, have, n = [], 0.0, (1 << 31) - 1
    while have <= bits:
        if _is_prime(n):
            out.append(n)
            have += math.log2(n) - 1e-9
        n -= 2
    return out


def coefficient_bits(m: list[list[int]]) -> int:
    """Bits that hold every coefficient with its sign: they are at most C(d, k) * (trace / d)**k, as no root is negative."""
    d, mean = len(m), Fraction(sum(m[i][i] for i in range(len(m))), len(m))
    size = math.log2(mean.numerator) - math.log2(mean.denominator) if mean else 0.0
    return math.ceil(max((math.lgamma(d + 1) - math.lgamma(k + 1) - math.lgamma(d - k + 1)) / math.log(2) + k * size for k in range(d + 1))) + 8


def polynomials(m: np.ndarray, moduli: list[int]) -> np.ndarray:
    """The characteristic polynomial of m modulo each prime, constant term first."""
    d, p = len(m), np.array(moduli, dtype=np.int64)[:, None]
    a = np.stack([(m % q).astype(np.int64) for q in moduli])
    each, q = np.arange(len(moduli)), p[:, :, None]
    for k in range(d - 2):
        pivot = k + 1 + np.argmax(a[:, k + 1 :, k] != 0, axis=1)
        top, low = a[each, k + 1].copy(), a[each, pivot].copy()
        a[each, k + 1], a[each, pivot] = low, top
        left, right = a[each, :, k + 1].copy(), a[each, :, pivot].copy()
        a[each, :, k + 1], a[each, :, pivot] = right, left
        inverse = np.array([pow(int(v), -1, int(r)) if v else 0 for v, r in zip(a[:, k + 1, k], moduli, strict=True)], dtype=np.int64)[:, None]
        u = a[:, k + 2 :, k] * inverse % p
        a[:, k + 2 :] = (a[:, k + 2 :] - u[:, :, None] * a[:, k + 1][:, None, :] % q) % q
        a[:, :, k + 1] = (a[:, :, k + 1] + (a[:, :, k + 2 :] * u[:, None, :] % q).sum(axis=2)) % p
    # Polynomials of the leading blocks, by expansion along the last column.
    poly = np.zeros((len(moduli), d + 1, d + 1), dtype=np.int64)
    poly[:, 0, 0] = 1
    for k in range(d):
        new = -(poly[:, k] * a[:, k, k][:, None] % p)
        new[:, 1:] += poly[:, k, :-1]
        below, factors = np.ones(len(moduli), dtype=np.int64), np.zeros((len(moduli), k), dtype=np.int64)
        for i in range(k - 1, -1, -1):
            below = below * a[:, i + 1, i] % p[:, 0]
            factors[:, i] = a[:, i, k] * below % p[:, 0]
        new -= (factors[:, :, None] * poly[:, :k] % q).sum(axis=1)
        poly[:, k + 1] = new % p
    return poly[:, d]


def characteristic(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Coefficients of det(x - m), the leading 1 first; primes are dealt to tasks."""
    moduli = primes(coefficient_bits(m))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scatter = np.array(m, dtype=object).reshape(len(m), len(m))
        for batch in batches:
            for i in range(0, batch.num_rows, PRIMES_A_TASK):
                own = batch.slice(i, PRIMES_A_TASK)
                yield pa.RecordBatch.from_pydict({"p": own.column("p"), "residues": pa.array(polynomials(scatter, own.column("p").to_pylist()).tolist(), pa.list_(pa.int64()))})

    dealt = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(-(-len(moduli) // PRIMES_A_TASK))
    rows = dealt.mapInArrow(reduce, "p long, residues array<long>").collect()
    whole = math.prod(r["p"] for r in rows)
    weights = [(whole // r["p"]) * pow(whole // r["p"], -1, r["p"]) for r in rows]
    found = [sum(r["residues"][k] * w for r, w in zip(rows, weights, strict=True)) % whole for k in range(len(m) + 1)]
    return [c - whole if 2 * c > whole else c for c in reversed(found)]


# --- roots ----------------------------------------------------------------------------------------------------------


def roots_above(poly: list[int], at: int, scale: int) -> int:
    """Roots above at / 2**scale of a polynomial whose roots are all real, by the sign changes of the shifted one."""
    c = [v << (scale * i) for i, v in enumerate(poly)]
    for end in range(len(c), 1, -1):
        for i in range(1, end):
            c[i] += c[i - 1] * at
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def value_at(poly: list[int], at: int, scale: int) -> int:
    """A number with the sign of the polynomial at at / 2**scale."""
    out = 0
    for i, v in enumerate(poly):
        out = out * at + (v << (scale * i))
    return out


@dataclass(frozen=True)
class Root:
    """A root times 2**scale is at, rounded up; count: how many roots are that close together."""

    at: int
    scale: int
    count: int


def largest_roots(poly: list[int], k: int) -> list[Root]:
    """The largest positive roots, in falling order, until there are k of them or no more."""
    top = 1 << max(1, (-poly[1]).bit_length()) if len(poly) > 1 and poly[1] < 0 else 0
    open_, out, have = ([(0, top, 0, roots_above(poly, 0, 0), 0)] if top else []), [], 0
    while open_ and have < k:
        low, high, scale, above_low, above_high = open_.pop()
        count = above_low - above_high
        if not count:
            continue
        if high - low == 1:
            if high.bit_length() >= PRECISION:
                out.append(Root(high, scale, count))
                have += count
                continue
            low, high, scale = 2 * low, 2 * high, scale + 1
        middle = (low + high) // 2
        if count == 1:
            # A single root: the sign above it is known, so one evaluation tells the half.
            sign = value_at(poly, middle, scale)
            right = sign != 0 and (sign > 0) == (above_high % 2 == 1)
            above = above_low if right else above_high
        else:
            above = roots_above(poly, middle, scale)
        open_.append((low, middle, scale, above_low, above))
        open_.append((middle, high, scale, above, above_high))
    return out


# --- null spaces ----------------------------------------------------------------------------------------------------


def _factored(a: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """LU with row exchanges, in fixed point; a zero pivot counts as the least number."""
    order = list(range(len(a)))
    for k in range(len(a)):
        p = max(range(k, len(a)), key=lambda i: abs(a[i, k]))
        a[[k, p]] = a[[p, k]]
        order[k], order[p] = order[p], order[k]
        a[k, k] = a[k, k] or 1
        if k + 1 < len(a):
            a[k + 1 :, k] = (a[k + 1 :, k] << POINT) // a[k, k]
            a[k + 1 :, k + 1 :] -= (a[k + 1 :, k][:, None] * a[k, k + 1 :][None, :]) >> POINT
    return a, order


def _solved(lu: np.ndarray, order: list[int], b: np.ndarray) -> np.ndarray:
    x = b[order].copy()
    for i in range(1, len(x)):
        x[i] -= (lu[i, :i] * x[:i]).sum() >> POINT
    for i in range(len(x) - 1, -1, -1):
        known = (lu[i, i + 1 :] * x[i + 1 :]).sum() >> POINT if i + 1 < len(x) else 0
        x[i] = ((x[i] - known) << POINT) // lu[i, i]
    return x


def null_space(m: np.ndarray, root: Root, seed: int = 7) -> list[list[float]]:
    """root.count orthonormal vectors that scatter - root takes to (nearly) nothing."""
    d = len(m)
    lu, order = _factored((m << POINT) - np.array([[((root.at << POINT) >> root.scale) if i == j else 0 for j in range(d)] for i in range(d)], dtype=object))
    start = np.random.default_rng(seed).integers(-(1 << 40), 1 << 40, (root.count, d))
    basis = [np.array([int(v) << (POINT - 40) for v in row], dtype=object) for row in start]
    for turn in range(60):
        before, basis = basis, []
        for v in before:
            y = _solved(lu, order, v)
            # Twice, as what is left may be small.
            for _ in range(2):
                y = (y << POINT) // math.isqrt(int((y * y).sum())) if any(y) else v
                for u in basis:
                    y = y - ((u * ((u * y).sum() >> POINT)) >> POINT)
            basis.append((y << POINT) // math.isqrt(int((y * y).sum())))
        moved = [min(max(abs(a - b)), max(abs(a + b))) for a, b in zip(before, basis, strict=True)]
        if max(moved) < 1 << (POINT - 80) if root.count == 1 else turn == 8:
            break
    return [[int(x) / (1 << POINT) for x in v] for v in basis]


def components(spark: SparkSession, m: list[list[int]], k: int = COMPONENTS) -> list[tuple[Fraction, list[float]]]:
    """(eigenvalue, unit vector) of the k largest positive eigenvalues of an integer matrix; a root is a task."""
    roots = largest_roots(characteristic(spark, m), k)
    if not roots:
        return []

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scatter = np.array(m, dtype=object).reshape(len(m), len(m))
        for batch in batches:
            for r in batch.to_pylist():
                found = null_space(scatter, Root(int(r["at"]), r["scale"], r["count"]))
                yield pa.RecordBatch.from_pydict({"i": pa.array([r["i"]], pa.int32()), "vectors": pa.array([found], pa.list_(pa.list_(pa.float64())))})

    asked = spark.createDataFrame([(i, str(r.at), r.scale, r.count) for i, r in enumerate(roots)], "i int, at string, scale int, count int").repartition(len(roots), "i")
    found = {r["i"]: r["vectors"] for r in asked.mapInArrow(solve, "i int, vectors array<array<double>>").collect()}
    return [(Fraction(r.at, 1 << r.scale), v) for i, r in enumerate(roots) for v in found[i]][:k]


# --- whitening ------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Of vectors of one length: n, the rounded means, the remainders of the sums, the eigenvalues and unit vectors of the
    covariance, and the eigenvalues' shares of its trace."""

    n: int
    centre: list[int]
    rest: list[int]
    values: list[float]
    vectors: list[list[float]]
    shares: list[float]


def fit(rows: DataFrame, k: int = COMPONENTS) -> dict[int, Model]:
    """A model for each length of vectors; rows: a written table of integers()."""
    spark, totals = rows.sparkSession, sums(rows)
    means = {dim: [(2 * s + n) // (2 * n) for s in total] for dim, (n, total) in totals.items()}
    out = {}
    for dim, c in scatters(rows, means).items() if means else ():
        n, rest = totals[dim][0], [s - totals[dim][0] * m for s, m in zip(totals[dim][1], means[dim], strict=True)]
        scatter = [[n * c[i][j] - rest[i] * rest[j] for j in range(dim)] for i in range(dim)]
        trace = sum(scatter[i][i] for i in range(dim))
        found = components(spark, scatter, k) if trace else []
        out[dim] = Model(n, means[dim], rest, [float(e / n**2) for e, _ in found], [v for _, v in found], [float(e / trace) for e, _ in found])
    return out


def projected(rows: DataFrame, models: dict[int, Model]) -> DataFrame:
    """(vec_id, dim, deviation, w array<double>) of all rows: distance from the mean, and the whitened components."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part, x in _matrices(batches):
            model = models[dim]
            d = centred(x, model.centre)
            n, rest = model.n, np.array(model.rest, dtype=object)
            most = n * max(abs(int(d.max())), abs(int(d.min()))) + max(abs(r) for r in model.rest)
            whole = d.astype(np.int64) * n - rest.astype(np.int64) if most * most * dim <= MOST else d.astype(object) * n - rest
            deviation = [min(int(v), MOST) for v in (whole * whole).sum(axis=1)]
            w = (d.astype(np.float64) - np.array([r / n for r in model.rest])) @ np.array(model.vectors).reshape(-1, dim).T / np.sqrt(np.array(model.values))
            yield pa.RecordBatch.from_pydict({"vec_id": part.column("vec_id"), "dim": part.column("dim"), "deviation": pa.array(deviation, pa.int64()), "w": pa.array(w.tolist(), pa.list_(pa.float64()))})

    return rows.mapInArrow(project, "vec_id long, dim int, deviation long, w array<double>")


def identity_errors(rows: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """(dim, identity_error): how far the covariance of the whitened rows is from the identity, at most."""
    means = rows.groupBy("dim").agg(F.array(*[F.avg(F.get("w", F.lit(i))) for i in range(k)]).alias("mean"))
    at = lambda i: F.get("w", F.lit(i)) - F.col("mean")[i]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = rows.join(means, "dim").groupBy("dim").agg(*[F.avg(at(i) * at(j)).alias(f"c{i}_{j}") for i, j in pairs])
    return cov.select("dim", F.greatest(F.lit(0.0), *[F.abs(F.col(f"c{i}_{j}") - float(i == j)) for i, j in pairs]).alias("identity_error"))


def whiten(vectors: DataFrame, vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every row that takes part and every
    component up to k."""
    spark = vectors.sparkSession
    with scratch(spark):
        rows = written(integers(vectors, vector), "integers")
        models = fit(rows, k)
        done = result(projected(rows, models), "whitened")
    errors = identity_errors(done, k)
    known = [(dim, i + 1, m.n, s) for dim, m in models.items() for i, s in enumerate(m.shares)]
    facts = spark.createDataFrame(known, "dim int, component int, n long, explained double")
    each = done.select("vec_id", "dim", "deviation", F.posexplode("w").alias("i", "whitened")).withColumn("component", F.col("i") + 1)
    return each.join(F.broadcast(facts), ["dim", "component"]).join(errors, "dim").select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 8 whitened components of every embedding."""
    return whiten(table(spark, sf_dir, "embeddings"))
