"""Whitening of embeddings by spectrum slicing.

The covariance of the distinct integer vectors is summed exactly, in two passes
(means first, then products of centred entries). Its leading eigenvalues are
found by slicing: the signs of D in an LDLᵀ factorisation of ``V - sI`` count
the eigenvalues above ``s``, bisection on the counts isolates each eigenvalue,
Rayleigh quotient iteration converges inside its interval, and counts beside
the result certify which eigenvalue it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.llm.shared import one_thread, write_stage

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Entries whose integer does not fit 62 bits count as not finite.
_LARGEST = float(1 << 55)
#: Eigenvalues below this share of the largest carry nothing but rounding; they are no components.
LEAST = 1e-10
#: Eigenvalues closer than this share of the largest are found together, as one invariant subspace.
_CLOSE = 1e-9
_EPS = float(np.finfo(np.float64).eps)


# ---------------------------------------------------------------- spectrum slicing

def count_above(v: np.ndarray, s: float) -> int:
    """Number of eigenvalues of ``v`` above ``s``: positive signs in D of an LDLᵀ of ``v - sI`` with 1x1 and 2x2 pivots."""
    a = v - s * np.eye(len(v))
    above = 0
    while len(a):
        size = np.abs(a)
        diag = size.diagonal().copy()
        np.fill_diagonal(size, 0.0)
        r, at = int(diag.argmax()), int(size.argmax())
        p, q = divmod(at, len(a))
        if diag[r] == 0 and size[p, q] == 0:
            return above   # what is left equals s
        if diag[r] >= 0.64 * size[p, q]:
            keep = np.arange(len(a)) != r
            d = a[r, r]
            above += d > 0
            col = a[keep, r]
            a = a[np.ix_(keep, keep)] - np.outer(col, col / d)
        else:   # both diagonal entries are smaller than the one beside them: one eigenvalue of the block is positive
            keep = (np.arange(len(a)) != p) & (np.arange(len(a)) != q)
            col = a[np.ix_(keep, [p, q])]
            above += 1
            a = a[np.ix_(keep, keep)] - col @ np.linalg.solve(a[np.ix_([p, q], [p, q])], col.T)
        a = (a + a.T) / 2
    return above


class Slicer:
    """Counts at shifts seen so far, from which intervals of single eigenvalues are cut."""

    def __init__(self, v: np.ndarray):
        self.v = v
        radius = np.abs(v).sum(1) - np.abs(v.diagonal())
        self.scale = max(float((v.diagonal() + radius).max()), float(np.abs(v).max()), np.finfo(np.float64).tiny)
        low, high = float((v.diagonal() - radius).min()) - _EPS * self.scale, float((v.diagonal() + radius).max()) * (1 + 4 * _EPS) + _EPS * self.scale
        self.counts = {low: len(v), high: 0}

    def count(self, s: float) -> int:
        if s not in self.counts:
            self.counts[s] = count_above(self.v, s)
        return self.counts[s]

    def interval(self, k: int) -> tuple[float, float]:
        """Narrowest known (a, b] that holds eigenvalue ``k`` (1 is the largest)."""
        return max(s for s, c in self.counts.items() if c >= k), min(s for s, c in self.counts.items() if c < k)

    def halve(self, k: int) -> None:
        a, b = self.interval(k)
        self.count((a + b) / 2)

    def isolate(self, k: int) -> tuple[float, float, int]:
        """Interval of eigenvalue ``k`` and how many eigenvalues share it once it can't be told from its neighbours."""
        while True:
            a, b = self.interval(k)
            alone = self.counts[a] == k and self.counts[b] == k - 1
            if alone or b - a <= _CLOSE * self.scale:
                return a, b, self.counts[a] - self.counts[b]
            self.halve(k)


def _solve(v: np.ndarray, s: float, x: np.ndarray, scale: float) -> np.ndarray:
    """(v - sI)⁻¹ x; a shift that is an eigenvalue to the last bit is moved by one unit."""
    try:
        z = np.linalg.solve(v - s * np.eye(len(v)), x)
        if np.isfinite(z).all():
            return z
    except np.linalg.LinAlgError:
        pass
    return np.linalg.solve(v - (s + 4 * _EPS * scale) * np.eye(len(v)), x)


def _rayleigh(slicer: Slicer, k: int) -> tuple[float, np.ndarray]:
    """Eigenvalue ``k`` and its unit vector by Rayleigh quotient iteration, kept inside the interval of ``k``."""
    v, scale = slicer.v, slicer.scale
    start = np.random.Generator(np.random.PCG64(k)).standard_normal(len(v))
    while True:
        a, b = slicer.interval(k)
        x = start
        for _ in range(2):   # inverse iteration turns the start towards the interval
            x = _solve(v, (a + b) / 2, x, scale)
            x = x / np.linalg.norm(x)
        rho, last = float(x @ v @ x), np.inf
        for _ in range(12):
            rest = float(np.linalg.norm(v @ x - rho * x))
            if not a < rho <= b or rest >= last and rest <= 64 * _EPS * scale:
                break
            last = rest
            z = _solve(v, rho, x, scale)
            x = z / np.linalg.norm(z)
            rho = float(x @ v @ x)
        rest = float(np.linalg.norm(v @ x - rho * x))
        if a < rho <= b and rest <= 64 * _EPS * scale * len(v) ** 0.5:
            return rho, x
        if b - a <= 4 * _EPS * scale:
            return (a + b) / 2, x
        slicer.halve(k)


def _together(slicer: Slicer, a: float, b: float, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues that can't be told apart: inverse iteration on a subspace, then Rayleigh and Ritz."""
    v = slicer.v
    x = np.random.Generator(np.random.PCG64(seed)).standard_normal((len(v), size))
    for _ in range(4):
        x = np.linalg.qr(_solve(v, (a + b) / 2 + _EPS * slicer.scale, x, slicer.scale))[0]
    values, turn = np.linalg.eigh(x.T @ v @ x)
    return values[::-1], (x @ turn)[:, ::-1]


def leading(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of ``v`` in falling order and their unit vectors as rows, numbering certified by counts."""
    slicer = Slicer(v)
    values, vectors, k = [], [], 1
    while k <= min(most, len(v)):
        a, b, size = slicer.isolate(k)
        if values and b <= LEAST * values[0]:
            break
        if size == 1:
            rho, x = _rayleigh(slicer, k)
            near = 256 * _EPS * slicer.scale
            if not (slicer.count(rho - near) >= k > slicer.count(rho + near)):
                raise ArithmeticError(f"counts do not certify eigenvalue {k}")
            values.append(rho)
            vectors.append(x)
        else:
            found, x = _together(slicer, a, b, size, k)
            values += found.tolist()
            vectors += list(x.T)
        k += size
    good = [i for i, e in enumerate(values[:most]) if e > max(LEAST * values[0], np.finfo(np.float64).tiny)]
    return np.array([values[i] for i in good]), np.array([vectors[i] for i in good]).reshape(len(good), len(v))


# ---------------------------------------------------------------- sums in tasks

def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and integer matrix of the vectors of each length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = column.offsets.to_numpy()
    size, flat = np.diff(at), column.values.to_numpy(zero_copy_only=False)
    for d in np.unique(size):
        if d:
            rows = np.flatnonzero(size == d)
            yield rows, flat[at[rows][:, None] + np.arange(d)]


def products(y: np.ndarray) -> np.ndarray:
    """Exact yᵀy as Python integers."""
    largest = int(np.abs(y).max(initial=0))
    if largest < 1 << 26:
        step = max(1, (1 << 53) // max(1, largest * largest))
        total = np.zeros((y.shape[1], y.shape[1]), object)
        for i in range(0, len(y), step):
            part = y[i:i + step].astype(np.float64)
            total = total + (part.T @ part).astype(np.int64).astype(object)   # sums below 2**53 are exact
        return total
    y = y.astype(object)
    return y.T @ y


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(int(v)) if abs(v) < 10 ** 38 else None for v in values], pa.decimal128(38, 0))


def _rows(held: dict[int, dict[tuple[int, int], int]]) -> pa.RecordBatch:
    rows = [(d, i, j, v) for d, sums in held.items() for (i, j), v in sums.items()]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int32()) for c in cols[:3]], _decimals(list(cols[3]))], ["d", "i", "j", "v"])


def _means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts (i = -1) and sums of each dimension (j = -1) of one task."""
    held: dict[int, dict[tuple[int, int], int]] = {}
    for b in batches:
        for _, x in _by_length(b.column("x")):
            sums = held.setdefault(x.shape[1], {})
            sums[-1, -1] = sums.get((-1, -1), 0) + len(x)
            # 62-bit entries: halves add up without overflow
            total = [(int(h) << 31) + int(l) for h, l in zip((x >> 31).sum(0), (x & 0x7FFFFFFF).sum(0), strict=True)]
            for i, v in enumerate(total):
                sums[i, -1] = sums.get((i, -1), 0) + v
    yield _rows(held)


def _centred(batches: Iterator[pa.RecordBatch], centre: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Sums of products of entries less the whole number next to their mean, of one task."""
    one_thread()
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for _, x in _by_length(b.column("x")):
            d = x.shape[1]
            held[d] = held.get(d, 0) + products(x - centre[d])
    yield _rows({d: {(i, j): m[i, j] for i in range(d) for j in range(i + 1)} for d, m in held.items()})


class Model:
    """Fit of the vectors of one length: count, sums, whole-number centre, eigenvalues and vectors."""

    def __init__(self, n: int, sums: list[int], total: np.ndarray, most: int):
        self.n, self.sums = n, sums
        self.centre = whole(n, sums)
        self.rest = [s - n * int(c) for s, c in zip(sums, self.centre, strict=True)]   # sums of centred entries
        d = len(sums)
        # V is a quotient of whole numbers, rounded once
        self.covariance = np.array([[(n * int(total[i, j]) - self.rest[i] * self.rest[j]) / (n * n) for j in range(d)] for i in range(d)], np.float64).reshape(d, d)
        self.values, self.vectors = leading(self.covariance, most) if self.covariance.any() else (np.zeros(0), np.zeros((0, d)))
        self.explained = (self.values / np.trace(self.covariance)) if len(self.values) else self.values
        self.turn = (self.vectors / np.sqrt(self.values)[:, None]).T
        self.shift = np.array([r / n for r in self.rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre).astype(np.float64) - self.shift) @ self.turn

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S)², exact."""
        y = x - self.centre
        if int(np.abs(y).max(initial=0)) >= 1 << 28:
            return [sum((self.n * int(c) - r) ** 2 for c, r in zip(row, self.rest, strict=True)) for row in y]
        square = np.einsum("ij,ij->i", y, y).tolist()
        cross, rest, place = [0] * len(y), [abs(r) for r in self.rest], 0
        sign = np.array([1 if r >= 0 else -1 for r in self.rest])
        while any(rest):   # in limbs of 24 bits, whose products with the entries fit 64 bits
            limb = np.array([r & 0xFFFFFF for r in rest], np.int64) * sign
            cross = [c + (v << place) for c, v in zip(cross, (y @ limb).tolist(), strict=True)]
            rest, place = [r >> 24 for r in rest], place + 24
        own = sum(r * r for r in self.rest)
        return [self.n * self.n * s - 2 * self.n * c + own for s, c in zip(square, cross, strict=True)]


def whole(n: int, sums: list[int]) -> np.ndarray:
    """The whole numbers next to the means."""
    return np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)


def _identity(batches: Iterator[pa.RecordBatch], models: dict[int, Model]) -> Iterator[pa.RecordBatch]:
    """Sums (j = -1) and products of whitened entries, of one task."""
    one_thread()
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for _, x in _by_length(b.column("x")):
            w = models[x.shape[1]].whitened(x)
            w = np.concatenate([w, np.ones((len(w), 1))], 1)
            held[x.shape[1]] = held.get(x.shape[1], 0) + w.T @ w
    rows = [(d, i, j, float(m[i, j])) for d, m in held.items() for i in range(len(m)) for j in range(len(m))]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
    yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int32()) for c in cols[:3]], pa.array(cols[3], pa.float64())], ["d", "i", "j", "v"])


def _project(batches: Iterator[pa.RecordBatch], models: dict[int, Model], error: dict[int, float]) -> Iterator[pa.RecordBatch]:
    one_thread()
    for b in batches:
        for rows, x in _by_length(b.column("x")):
            model = models[x.shape[1]]
            n, k = len(x), len(model.values)
            at = pa.array(np.arange(n + 1) * k, pa.int32())
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(pa.array(rows)), pa.array(np.full(n, model.n), pa.int64()), _decimals(model.deviation(x)),
                pa.ListArray.from_arrays(at, pa.array(model.whitened(x).ravel(), pa.float64())),
                pa.ListArray.from_arrays(at, pa.array(np.tile(model.explained, n), pa.float64())),
                pa.array(np.full(n, error[x.shape[1]]), pa.float64())], ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])


def _integers(vector: str) -> Column:
    return F.transform(F.col(vector).cast("array<double>"), lambda c: F.floor(c * SCALE).cast("long") + OFFSET)


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation, whitened and explained (arrays by component) and identity_error of each row that has a vector.

    Every distinct vector counts once in the fit (distinct rows are combined in
    tasks before the shuffle, so a vector that most rows share is no burden). The
    driver collects sums only: d * d / 2 numbers for vectors of d entries.

    Edge cases: rows whose vector is null, or holds null or non-finite entries
    (or entries beyond 2**55), are left out; repeated rows and null ids are
    projected like others; vectors of another length have a fit of their own;
    components that carry no variance (below 1e-10 of the largest) are left out,
    so a fit of one vector has none; empty vectors have none and are left out;
    an empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    ok = F.col(vector).isNotNull() & F.forall(F.col(vector).cast("array<double>"), lambda c: F.coalesce(F.abs(c) < _LARGEST, F.lit(False)))
    rows = vectors.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), _integers(vector).alias("x"))
    fit = write_stage(rows.select("x").distinct(), "whiten-fit")
    sums = "d int, i int, j int, v decimal(38,0)"

    def collected(frame: DataFrame) -> dict[int, dict[tuple[int, int], int]]:
        found: dict[int, dict[tuple[int, int], int]] = {}
        for r in frame.groupBy("d", "i", "j").agg(F.sum("v").alias("v")).collect():
            found.setdefault(r["d"], {})[r["i"], r["j"]] = r["v"]
        return found

    first = {d: (int(s[-1, -1]), [int(s[i, -1]) for i in range(d)]) for d, s in collected(fit.mapInArrow(_means, sums)).items()}
    centre = {d: whole(n, s) for d, (n, s) in first.items()}
    second = collected(fit.mapInArrow(lambda b: _centred(b, centre), sums))
    models = {d: Model(n, s, np.array([[int(second[d][max(i, j), min(i, j)]) for j in range(d)] for i in range(d)], object), components) for d, (n, s) in first.items()}
    third = collected(fit.mapInArrow(lambda b: _identity(b, models), "d int, i int, j int, v double"))
    error = {}
    for d, model in models.items():
        k = len(model.values)
        m = np.array([[third[d][i, j] for j in range(k + 1)] for i in range(k + 1)]) / model.n
        error[d] = float(np.abs(m[:k, :k] - np.outer(m[:k, k], m[:k, k]) - np.eye(k)).max(initial=0.0))
    out = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    return rows.mapInArrow(lambda b: _project(b, models, error), out) if models else spark.createDataFrame([], out)
