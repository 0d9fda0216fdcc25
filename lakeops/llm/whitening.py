"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

An entry c becomes the whole number x = floor(64 c) + 1000000. The fit list holds
every distinct x vector once. Tasks return sums over their share of it, in whole
numbers: first the sums S of each dimension, then the products of the vectors
centred at m, the mean rounded to a whole number. What the rounding left,
r = S - n m, is taken out exactly (n Z - r r' over n^2), so the covariance V is
rounded once, however far the data lie from zero and in whatever order tasks end.

The driver holds d x d numbers for vectors of d entries, never rows. It factors
V = P L L' P' by Cholesky with diagonal pivots and turns the columns of the
triangular factor L itself until they are orthogonal (one-sided Jacobi): with
L J = U D, V = P U D^2 U' P'. So the squared column norms are the eigenvalues and
the normalised columns, put back into V's order, the components. V is never
multiplied out again and small eigenvalues keep their digits. Both run in long
double.

Defined cases: vectors that are NULL or hold NULL or non-finite entries are
dropped; entries beyond 2^46 count as 2^46; a NULL or repeated vec_id is a row
like any other; vectors of different lengths are fitted and projected apart, each length a
fit list of its own (an empty vector has no component); a dimension that the ones before
it determine to within RANK of its variance adds no component, so constant or repeated
dimensions, a single vector or an empty table give fewer components or none; other
columns of the input are not read. A deviation beyond a long is NULL."""

from __future__ import annotations

import decimal
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import written
from .topk_search import valid

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 52)    # of floor(64 c)
COMPONENTS = 16
RANK = 1e-13                # of a dimension's variance
SWEEPS = 60                 # far beyond the 6 to 10 that Jacobi takes
_HALF = 26                  # bits; halves of an entry add up without overflow
_SUM = pa.decimal128(38, 0)


@dataclass
class Model:
    """What a task needs to project vectors of one length."""
    n: int
    middle: np.ndarray          # m, whole
    rest: list[int]             # r = S - n m
    components: np.ndarray      # d x k, unit columns
    values: np.ndarray          # k eigenvalues, falling
    explained: np.ndarray       # k shares of the trace


def whole_entries(vector: Column) -> Column:
    """x of every entry, as longs."""
    def x(c):
        v = F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST)))
        return v.cast("long") + SHIFT
    return F.transform(vector, x)


def matrices(batch: pa.RecordBatch, column: str = "x"):
    """(row numbers, int64 matrix) for each length of vector in a batch."""
    lists = batch.column(column)
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    for d in np.unique(lengths):
        rows = np.nonzero(lengths == d)[0]
        if d and len(rows):
            yield rows, flat[starts[rows][:, None] + np.arange(d)]


# ---------------------------------------------------------------- sums over the fit list

def _sums(batches):
    found: dict[int, list] = {}
    for batch in batches:
        for _, x in matrices(batch):
            n, high, low = found.get(x.shape[1], (0, 0, 0))
            found[x.shape[1]] = [n + len(x), high + (x >> _HALF).sum(axis=0),
                                 low + (x & ((1 << _HALF) - 1)).sum(axis=0)]
    for d, (n, high, low) in found.items():
        s = [decimal.Decimal((int(a) << _HALF) + int(b)) for a, b in zip(high, low)]
        yield pa.RecordBatch.from_pydict({
            "d": pa.array([d] * d, pa.int32()), "i": pa.array(range(d), pa.int32()),
            "n": pa.array([n] * d, pa.int64()), "s": pa.array(s, _SUM)})


def products(z: np.ndarray) -> np.ndarray:
    """z' z exactly, as Python numbers: in float64 where all sums are below
    2^53, by rows few enough for that."""
    top = int(np.abs(z).max(initial=0))
    rows = (1 << 53) // max(1, top * top)
    if rows < 1:
        z = z.astype(object)
        return z.T @ z
    f = z.astype(np.float64)
    parts = [f[i:i + rows] for i in range(0, len(f), rows)]
    return sum((p.T @ p).astype(np.int64).astype(object) for p in parts)


def _products(middles: dict[int, np.ndarray]):
    def run(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in matrices(batch):
                d = x.shape[1]
                found[d] = products(x - middles[d]) + found.get(d, 0)
        for d, z in found.items():
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_pydict({
                "d": pa.array([d] * len(i), pa.int32()), "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()),
                "s": pa.array([decimal.Decimal(int(v)) for v in z[i, j]], _SUM)})
    return run


# ---------------------------------------------------------------- the fit, of d x d numbers

def _ratio(a: int, b: int) -> np.longdouble:
    """a / b for whole numbers, rounded to a long double."""
    whole, rest = divmod(a, b)
    bits = max(0, 80 - max(0, whole.bit_length()))
    return np.longdouble(whole) + np.ldexp(np.longdouble((rest << bits) // b), -bits)


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, L): v[order][:, order] = L L', L lower triangular with as many
    columns as the matrix has rank."""
    d = len(v)
    own, left, order, l = np.diag(v).copy(), np.diag(v).copy(), np.arange(d), np.zeros((d, d), v.dtype)
    for k in range(d):
        open_ = np.where(left[k:] > RANK * own[order[k:]], left[k:], -1)
        p = k + int(np.argmax(open_))
        if open_[p - k] <= 0:
            return order, l[:, :k]
        for a in (order, left, l):
            a[[k, p]] = a[[p, k]]
        l[k, k] = np.sqrt(left[k])
        l[k + 1:, k] = (v[order[k + 1:], order[k]] - l[k + 1:, :k] @ l[k, :k]) / l[k, k]
        left[k + 1:] -= l[k + 1:, k] ** 2
    return order, l


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` times the rotations that make its columns orthogonal. A
    sweep meets every pair of columns once, in rounds of disjoint pairs (the
    round-robin order), each round turned together."""
    a, eps = factor.copy(), np.finfo(factor.dtype).eps
    r = a.shape[1]
    ring = np.arange(r + r % 2)
    for _ in range(SWEEPS):
        most = 0.0
        for _ in range(max(1, len(ring) - 1)):
            half = len(ring) // 2
            p, q = ring[:half], ring[half:][::-1]
            real = (p < r) & (q < r)
            p, q = p[real], q[real]
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            size = np.sqrt(xx * yy)
            off = np.abs(xy) > eps * size
            if off.any():
                most = max(most, float((np.abs(xy[off]) / size[off]).max()))
                p, q, x, y, xx, yy, xy = p[off], q[off], x[:, off], y[:, off], xx[off], yy[off], xy[off]
                t = (yy - xx) / (2 * xy)
                t = np.where(t >= 0, 1, -1) / (np.abs(t) + np.sqrt(1 + t * t))
                c = 1 / np.sqrt(1 + t * t)
                a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
            ring = np.concatenate((ring[:1], ring[-1:], ring[1:-1]))
        if most <= len(a) * eps:
            return a
    raise ArithmeticError(f"one-sided Jacobi has not settled after {SWEEPS} sweeps")


def fit(n: int, sums: list[int], middle: list[int], z: dict[tuple[int, int], int], k: int = COMPONENTS) -> Model:
    """The model from the fit list's whole sums."""
    d, rest = len(sums), [s - n * m for s, m in zip(sums, middle)]
    v = np.zeros((d, d), np.longdouble)
    for (i, j), s in z.items():
        v[i, j] = v[j, i] = _ratio(n * s - rest[i] * rest[j], n * n)
    order, l = pivoted_cholesky(v)
    turned = one_sided_jacobi(l)
    norms = np.sqrt((turned * turned).sum(axis=0))
    first = np.argsort(-norms, kind="stable")[:k]
    components = np.zeros((d, len(first)), np.longdouble)
    components[order] = turned[:, first] / norms[first]
    top = np.abs(components).argmax(axis=0)     # one sign: the largest entry is positive
    components *= np.where(components[top, np.arange(len(first))] < 0, -1, 1)
    values = norms[first] ** 2
    return Model(n, np.array(middle, np.int64), rest, components.astype(np.float64), values.astype(np.float64),
                 (values / np.trace(v)).astype(np.float64))


def fitted(rows: DataFrame, k: int = COMPONENTS) -> tuple[dict[int, Model], DataFrame]:
    """Models by length of vector, and the written fit list (x)."""
    listed = written(rows.select("x").distinct(), "fit-list")
    sums = (listed.mapInArrow(_sums, "d int, i int, n long, s decimal(38,0)")
            .groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("d", "i").collect())
    totals: dict[int, tuple[int, list[int]]] = {}
    for r in sums:
        totals.setdefault(r.d, (r.n, []))[1].append(int(r.s))
    middles = {d: [(2 * s + n) // (2 * n) for s in ss] for d, (n, ss) in totals.items()}
    summed = (listed.mapInArrow(_products({d: np.array(m, np.int64) for d, m in middles.items()}),
                                "d int, i int, j int, s decimal(38,0)")
              .groupBy("d", "i", "j").agg(F.sum("s").alias("s")).collect() if totals else [])
    z: dict[int, dict] = {}
    for r in summed:
        z.setdefault(r.d, {})[r.i, r.j] = int(r.s)
    return {d: fit(n, ss, middles[d], z[d], k) for d, (n, ss) in totals.items()}, listed


# ---------------------------------------------------------------- projection

def whitened(x: np.ndarray, m: Model) -> np.ndarray:
    """Rows centred, projected on the components and scaled to variance one."""
    rest = np.array([r / m.n for r in m.rest])
    return ((x - m.middle) - rest) @ m.components / np.sqrt(m.values)


def deviations(x: np.ndarray, m: Model) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exactly; None beyond a long."""
    z, rest = x - m.middle, max((abs(r) for r in m.rest), default=0)
    if (m.n * int(np.abs(z).max(initial=0)) + rest) ** 2 * x.shape[1] < 1 << 63:
        y = z * m.n - np.array(m.rest, np.int64)
        return (y * y).sum(axis=1).tolist()
    y = z.astype(object) * m.n - np.array(m.rest, object)
    return [int(s) if s < 1 << 63 else None for s in (y * y).sum(axis=1)]


def identity_errors(listed: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """By length: the largest absolute entry of the covariance of the whitened
    fit list minus the identity. Whitened rows are centred already: S - n m - r
    is zero."""
    def run(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in matrices(batch):
                w = whitened(x, models[x.shape[1]])
                found[x.shape[1]] = w.T @ w + found.get(x.shape[1], 0)
        for d, s in found.items():
            i, j = np.triu_indices(len(s))
            yield pa.RecordBatch.from_pydict({
                "d": pa.array([d] * len(i), pa.int32()), "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()),
                "s": pa.array(s[i, j])})

    sums = (listed.mapInArrow(run, "d int, i int, j int, s double")
            .groupBy("d", "i", "j").agg(F.sum("s").alias("s")).collect() if models else [])
    worst = dict.fromkeys(models, 0.0)
    for r in sums:
        worst[r.d] = max(worst[r.d], abs(r.s / models[r.d].n - (r.i == r.j)))
    return worst


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """A row for each valid vector and component (see the module): vec_id,
    component, n, deviation, whitened, explained, identity_error."""
    rows = (df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("v"))
            .where(valid(F.col("v"))).select("vec_id", whole_entries(F.col("v")).alias("x")))
    models, listed = fitted(rows, k)
    errors = identity_errors(listed, models)

    def run(batches):
        for batch in batches:
            ids = batch.column("vec_id")
            for at, x in matrices(batch):
                m = models[x.shape[1]]
                w, own = whitened(x, m), len(m.values)
                dev = pa.array(deviations(x, m), pa.int64())
                each = pa.array(np.repeat(np.arange(len(at)), own))
                count = len(at) * own
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(at)).take(each), pa.array(np.tile(np.arange(1, own + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(count, m.n, np.int64)), dev.take(each), pa.array(w.ravel()),
                    pa.array(np.tile(m.explained, len(at))), pa.array(np.full(count, errors[x.shape[1]]))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, "
                                "explained double, identity_error double")
