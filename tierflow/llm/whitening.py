"""Principal components of embeddings from exact integers, and vectors whitened by them.

Entries become whole numbers, so the sums of products over the distinct vectors are exact in
any order. With n of them, their sums S and their scatter A = n * sum(y y') - S S', the
covariance is A / n^2, and its eigenvalues are those of the integer matrix A over n^2.

* The characteristic polynomial of A is found modulo many primes, each on its own in a task:
  a similarity transform to Hessenberg form, then the recurrence for its leading minors. As
  A has no negative eigenvalue, Maclaurin's inequality bounds every coefficient, so a known
  number of primes is enough for Chinese remaindering to give the exact integers.
* All roots are real. Descartes' rule of signs is then exact: p(x + a) has as many changes of
  sign as p has roots above a, with their multiplicity. Halving intervals isolates the
  largest roots, and halving by the sign of p alone refines them to PRECISION bits.
* A component is the null space of A - root * I: inverse iteration with decimals of enough
  digits, from a fixed start. Roots that agree to SAME bits are one root of some
  multiplicity, whose space is spanned orthonormally.

Spark adds the sums of products up, works on the primes and the components, and whitens. What
reaches the driver are d x d sums, d coefficients per prime and the components, for d
dimensions: no bound grows with the rows.

Vectors that are null or hold a null, a NaN or an infinity take no part. All others are taken
to have the dimension of the longest; shorter ones are left out. Entries beyond the range of
long are held at its ends. Repeated vectors count once, but every row gets its result, also
with a null or repeated id. Components with eigenvalue 0 cannot be whitened and are left out,
so a table of a single distinct vector gives an empty result, like an empty one. Equal
eigenvalues are numbered by the order of the fixed starts. Other columns are ignored.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import bounded, stored

COMPONENTS = 16
# An entry c becomes floor(STEPS * c); what the contract adds to it cancels everywhere.
STEPS = 64
# Bits to which a root is known, relative to itself.
PRECISION = 128
# Roots that agree to so many bits share a space.
SAME = 80
# Sums of products travel as limbs of so many bits, whose own sums fit a long.
LIMB = 30
_FITTING = "array<long>"


@dataclass(frozen=True)
class Components:
    """What is learnt: number of distinct vectors, their sums, eigenvalues of the scatter
    (falling), unit eigenvectors as rows, and the scatter's trace."""

    n: int
    sums: list[int]
    roots: list[Fraction]
    vectors: np.ndarray
    trace: int

    @property
    def eigenvalues(self) -> np.ndarray:
        return np.array([float(r / self.n**2) for r in self.roots])

    @property
    def explained(self) -> list[float]:
        return [float(r / self.trace) for r in self.roots]


def whiten(rows: DataFrame, id: str, vector: str, components: int = COMPONENTS) -> DataFrame:
    """`id`, `component`, `n`, `deviation` (exact, as a decimal; null beyond 38 digits), `whitened`,
    `explained` and `identity_error`, for every row and component."""
    bounded(rows.sparkSession)
    kind = rows.schema[id].dataType
    whole = _whole(rows.select(F.col(id).alias("id"), F.col(vector).alias("v")))
    fitted = stored(whole.select("y").distinct(), "whitening-fit")
    model = fit(fitted, components)
    if model is None or not model.roots:
        return rows.sparkSession.createDataFrame([], f"id {kind.simpleString()}, {_RESULT}")
    error = identity_error(fitted, model)
    explained = model.explained

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch, len(model.sums))
            if not len(y):
                continue
            centred = _centred(y, model)
            wide = centred.astype(object) if centred.dtype == object or _over(centred) else centred
            deviation = [int(x) for x in (wide * wide).sum(axis=1)]
            white = _project(centred, model)
            k = len(model.roots)
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(len(y)), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                pa.array([None if d >= 10**38 else decimal.Decimal(d) for d in deviation for _ in range(k)], pa.decimal128(38, 0)),
                pa.array(white.ravel()),
                pa.array(np.tile(explained, len(y))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "component", "deviation", "whitened", "explained"])

    found = whole.mapInArrow(run, f"id {kind.simpleString()}, component int, deviation decimal(38,0), whitened double, explained double")
    return found.withColumns({"n": F.lit(model.n).cast("long"), "identity_error": F.lit(error)})


_RESULT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def _whole(rows: DataFrame) -> DataFrame:
    """`id` and the whole numbers `y` of every vector that takes part."""
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = rows.filter(F.col("v").isNotNull() & finite)
    d = usable.agg(F.max(F.size("v"))).first()[0] or 0
    y = F.transform("v", lambda c: F.floor(F.lit(float(STEPS)) * c.cast("double")))
    return usable.filter((F.size("v") == d) & (F.size("v") > 0)).select("id", y.alias("y"))


def fit(fitted: DataFrame, components: int) -> Components | None:
    """Components of distinct whole-number vectors `y`; None if there are none."""
    products = _products(fitted)
    if products is None:
        return None
    n, sums = int(products[0, 0]), [int(x) for x in products[0, 1:]]
    outer = np.array(sums, dtype=object)
    scatter = n * products[1:, 1:] - np.outer(outer, outer)
    trace = int(np.trace(scatter))
    if not trace:
        return Components(n, sums, [], np.zeros((0, len(sums))), 0)
    spark = fitted.sparkSession
    roots = largest_roots(characteristic(spark, scatter), components)
    return Components(n, sums, roots, _vectors(spark, scatter, roots), trace)


# --- sums of products -------------------------------------------------------


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    y = batch.column(batch.schema.get_field_index("y"))
    return y.flatten().to_numpy(zero_copy_only=False).reshape(-1, d) if len(y) else np.zeros((0, d), dtype=np.int64)


def _products(fitted: DataFrame) -> np.ndarray | None:
    """Sums of products of the columns of (1, y), as exact whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            d = len(batch.column(0)[0])
            y = np.concatenate([np.ones((batch.num_rows, 1), dtype=np.int64), _matrix(batch, d)], axis=1)
            most = max(int(y.max()), -int(y.min()))
            # Doubles hold whole numbers below 2^53 exactly.
            part = (y.T.astype(float) @ y.astype(float)).astype(np.int64) if most * most * len(y) < 1 << 53 else y.T.astype(object) @ y.astype(object)
            total = part.astype(object) if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total))
            limbs = [(int(a), int(b), k, limb) for a, b in zip(i, j, strict=True) for k, limb in enumerate(_limbs(int(total[a, b])))]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*limbs, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", "k", "limb"])

    parts = fitted.mapInArrow(run, "i int, j int, k int, limb long")
    summed = parts.groupBy("i", "j", "k").agg(F.sum("limb").alias("limb")).toArrow()
    if not summed.num_rows:
        return None
    size = max(summed["i"].to_pylist()) + 1
    out = np.zeros((size, size), dtype=object)
    for i, j, k, limb in zip(*(summed[c].to_pylist() for c in ("i", "j", "k", "limb")), strict=True):
        out[i, j] += limb << (LIMB * k)
    return out + np.triu(out, 1).T


def _limbs(value: int) -> list[int]:
    """Limbs of a whole number from the least up; the last one has its sign."""
    out = []
    while not -(1 << LIMB) < value < 1 << LIMB:
        value, low = value >> LIMB, value & ((1 << LIMB) - 1)
        out.append(low)
    return [*out, value]


# --- characteristic polynomial ----------------------------------------------


def characteristic(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients of det(x - matrix), from x^d down, of a whole-number matrix without
    negative eigenvalues."""
    d, trace = len(matrix), int(np.trace(matrix))
    # The k-th one is at most C(d, k) * (trace / d)^k.
    most = max(math.comb(d, k) * -(-(trace**k) // d**k) for k in range(d + 1))
    primes = _primes(most.bit_length() + 2)
    shared = spark.sparkContext.broadcast(matrix.tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_characteristic_mod(np.array([[x % p for x in row] for row in shared.value], dtype=np.int64), p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["p", "coefficients"])

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    dealt = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    found = dict(map(tuple, dealt.mapInArrow(run, "p long, coefficients array<long>").collect()))
    modulus = math.prod(found)
    weights = {p: modulus // p * pow(modulus // p, -1, p) for p in found}
    whole = [sum(weights[p] * c[k] for p, c in found.items()) % modulus for k in range(d + 1)]
    return [c - modulus if 2 * c > modulus else c for c in whole]


def _primes(bits: int) -> list[int]:
    """Primes below 2^31, from the largest down, whose product has more than `bits` bits."""
    out, product, p = [], 1, (1 << 31) - 1
    while product.bit_length() <= bits:
        if _is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def _is_prime(p: int) -> bool:
    """Miller and Rabin's test for an odd number; these bases settle all below 2^31."""
    odd, twos = p - 1, 0
    while not odd % 2:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, p)
        if x not in (1, p - 1) and not any((x := x * x % p) == p - 1 for _ in range(twos - 1)):
            return False
    return True


def _characteristic_mod(h: np.ndarray, p: int) -> list[int]:
    """det(x - h) modulo a prime below 2^31: no product exceeds 62 bits."""
    d = len(h)
    for c in range(d - 2):
        below = np.flatnonzero(h[c + 1 :, c])
        if not len(below):
            continue
        pivot = c + 1 + int(below[0])
        if pivot != c + 1:
            h[[c + 1, pivot]] = h[[pivot, c + 1]]
            h[:, [c + 1, pivot]] = h[:, [pivot, c + 1]]
        factor = h[c + 2 :, c] * pow(int(h[c + 1, c]), -1, p) % p
        h[c + 2 :] = (h[c + 2 :] - factor[:, None] * h[c + 1] % p) % p
        h[:, c + 1] = (h[:, c + 1] + (h[:, c + 2 :] * factor % p).sum(axis=1)) % p
    # minors[k]: characteristic polynomial of the leading k x k block, from x^0 up.
    minors = [np.array([1], dtype=np.int64)]
    for k in range(d):
        minor = np.append(0, minors[k])
        minor[:-1] = (minor[:-1] - int(h[k, k]) * minors[k]) % p
        under = 1
        for i in range(k - 1, -1, -1):
            under = under * int(h[i + 1, i]) % p
            if not under:
                break
            minor[: i + 1] = (minor[: i + 1] - under * int(h[i, k]) % p * minors[i]) % p
        minors.append(minor)
    return [int(x) for x in minors[d][::-1]]


# --- roots -------------------------------------------------------------------


def roots_above(coefficients: Sequence[int], a: int) -> int:
    """How many roots exceed `a`, if all are real, by the signs of the shifted polynomial."""
    shifted = list(coefficients)
    for stop in range(len(shifted) - 1, 0, -1):
        for k in range(1, stop + 1):
            shifted[k] += a * shifted[k - 1]
    signs = [c > 0 for c in shifted if c]
    return sum(s != t for s, t in zip(signs, signs[1:], strict=False))


def largest_roots(coefficients: Sequence[int], most: int) -> list[Fraction]:
    """The largest positive roots, falling and with multiplicity, of a monic polynomial whose
    roots are all real and none negative."""
    wanted = min(most, roots_above(coefficients, 0))
    bits = PRECISION
    while True:
        found = _largest(coefficients, wanted, bits)
        # A root close to 0 needs a finer grid for the same relative precision.
        if all(r >= Fraction(1, 1 << (bits - PRECISION // 2)) for r in found):
            return found
        bits *= 2


def _largest(coefficients: Sequence[int], wanted: int, bits: int) -> list[Fraction]:
    """Those roots on the grid of 2^-bits."""
    scaled = [c << (bits * k) for k, c in enumerate(coefficients)]
    out: list[Fraction] = []
    # Every root is at most the sum of all.
    stack = [(0, -scaled[1] + 1, roots_above(scaled, 0), 0)]
    while stack and len(out) < wanted:
        # `inside` roots lie above `lo` and not above `hi`.
        lo, hi, at_lo, at_hi = stack.pop()
        inside = at_lo - at_hi
        if not inside:
            continue
        if inside == 1:
            lo, hi = _refined(scaled, lo, hi)
        if hi - lo <= max(lo >> PRECISION, 1):
            out += [Fraction(lo + hi, 2 << bits)] * inside
            continue
        mid = (lo + hi) // 2
        at_mid = roots_above(scaled, mid)
        stack += [(lo, mid, at_lo, at_mid), (mid, hi, at_mid, at_hi)]
    return out[:wanted]


def _refined(scaled: Sequence[int], lo: int, hi: int) -> tuple[int, int]:
    """The interval of a single root, halved by the polynomial's sign."""

    def value(x: int) -> int:
        out = 0
        for c in scaled:
            out = out * x + c
        return out

    above = value(hi) or value(hi + 1)
    while hi - lo > max(lo >> PRECISION, 1):
        mid = (lo + hi) // 2
        if (value(mid) > 0) == (above > 0):
            hi = mid
        else:
            lo = mid
    return lo, hi


# --- components --------------------------------------------------------------


def _vectors(spark: SparkSession, matrix: np.ndarray, roots: Sequence[Fraction]) -> np.ndarray:
    """Unit eigenvectors as rows: a task for each root, or for roots that are one."""
    spaces: list[list[int]] = []
    for i, root in enumerate(roots):
        if spaces and roots[spaces[-1][0]] - root <= root / (1 << SAME):
            spaces[-1].append(i)
        else:
            spaces.append([i])
    shared = spark.sparkContext.broadcast(matrix.tolist())
    tasks = [(s[0], len(s), str(roots[s[0]].numerator), str(roots[s[0]].denominator)) for s in spaces]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for first, size, above, below in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                space = null_space(shared.value, Fraction(int(above), int(below)), size)
                out += [(first + k, v) for k, v in enumerate(space)]
            columns = [pa.array([k for k, _ in out], pa.int32()), pa.array([v for _, v in out], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["component", "vector"])

    dealt = spark.createDataFrame(tasks, "first int, size int, above string, below string").repartition(len(tasks))
    found = dict(map(tuple, dealt.mapInArrow(run, "component int, vector array<double>").collect()))
    return np.array([found[i] for i in range(len(roots))])


def null_space(matrix: list[list[int]], root: Fraction, size: int) -> list[list[float]]:
    """Orthonormal vectors of the eigenvalue `root` by inverse iteration."""
    digits = max(len(str(abs(x))) for row in matrix for x in row)
    with decimal.localcontext(prec=digits + 3 * PRECISION // 4):
        shift = decimal.Decimal(root.numerator) / root.denominator
        lower = np.array([[decimal.Decimal(x) for x in row] for row in matrix], dtype=object)
        d = len(lower)
        lower[np.arange(d), np.arange(d)] -= shift
        least = shift.scaleb(-decimal.getcontext().prec)
        order = np.arange(d)
        for c in range(d):
            pivot = c + int(np.argmax(np.abs(lower[c:, c])))
            if pivot != c:
                lower[[c, pivot]] = lower[[pivot, c]]
                order[[c, pivot]] = order[[pivot, c]]
            if abs(lower[c, c]) < least:
                # The root is exact: any pivot this small points into the null space.
                lower[c, c] = least
            lower[c + 1 :, c] /= lower[c, c]
            lower[c + 1 :, c + 1 :] -= np.outer(lower[c + 1 :, c], lower[c, c + 1 :])
        state = 1
        space = np.empty((size, d), dtype=object)
        for k in range(size):
            for i in range(d):
                # A fixed sequence without pattern, so that no start lacks a direction.
                state = state * 48271 % 2147483647
                space[k, i] = decimal.Decimal(state) / 2147483647 - decimal.Decimal("0.5")
        for _ in range(4):
            for k in range(size):
                x = space[k][order]
                for i in range(1, d):
                    x[i] -= lower[i, :i] @ x[:i]
                for i in range(d - 1, -1, -1):
                    x[i] = (x[i] - (lower[i, i + 1 :] @ x[i + 1 :] if i + 1 < d else 0)) / lower[i, i]
                x = x / max(abs(v) for v in x)
                for _ in range(2):
                    for j in range(k):
                        x = x - (x @ space[j]) * space[j]
                    x = x / (x @ x).sqrt()
                space[k] = x
        return [[float(v) for v in x] for x in space]


# --- whitening ---------------------------------------------------------------


def _over(centred: np.ndarray) -> bool:
    """Whether the sum of a row's squares might not fit 63 bits."""
    most = max(int(centred.max()), -int(centred.min()))
    return most * most * centred.shape[1] >= 1 << 63


def _centred(y: np.ndarray, model: Components) -> np.ndarray:
    """n * y - S, exact."""
    most = max(int(y.max()), -int(y.min()), 1) * model.n + max(map(abs, model.sums))
    if most < 1 << 62:
        return y * model.n - np.array(model.sums, dtype=np.int64)
    return y.astype(object) * model.n - np.array(model.sums, dtype=object)


def _project(centred: np.ndarray, model: Components) -> np.ndarray:
    return (centred / model.n).astype(float) @ (model.vectors / np.sqrt(model.eigenvalues)[:, None]).T


def identity_error(fitted: DataFrame, model: Components) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, measured on them:
    each task centres at its own mean, and the tasks' means are centred at the common one."""
    k = len(model.roots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, spread = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if not batch.num_rows:
                continue
            white = _project(_centred(_matrix(batch, len(model.sums)), model), model)
            own = white.mean(axis=0)
            away = own - mean
            both = n + len(white)
            spread += (white - own).T @ (white - own) + np.outer(away, away) * (n * len(white) / both)
            mean, n = mean + away * len(white) / both, both
        if n:
            columns = [pa.array([n]), pa.array([mean.tolist()]), pa.array([spread.ravel().tolist()])]
            yield pa.RecordBatch.from_arrays(columns, ["n", "mean", "spread"])

    parts = stored(fitted.mapInArrow(run, "n long, mean array<double>, spread array<double>"), "whitening-spread")
    means = parts.select("n", F.posexplode("mean").alias("i", "m")).groupBy("i").agg((F.sum(F.col("n") * F.col("m")) / model.n).alias("m"))
    common = np.zeros(k)
    for i, m in means.collect():
        common[i] = m
    at = F.array(*(F.lit(float(m)) for m in common))
    spread = parts.select("n", "mean", F.posexplode("spread").alias("at", "s"))
    row, column = F.expr(f"CAST(at DIV {k} AS INT)"), F.expr(f"CAST(at % {k} AS INT)")
    away = (F.get("mean", row) - F.get(at, row)) * (F.get("mean", column) - F.get(at, column))
    entry = F.sum(F.col("s") + F.col("n") * away) / model.n
    off = spread.groupBy("at").agg(entry.alias("v")).select(F.abs(F.col("v") - F.when(row == column, 1.0).otherwise(0.0)).alias("e"))
    return float(off.agg(F.max("e")).first()[0])
