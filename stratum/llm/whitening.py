"""Embedding whitening by an incremental, distributed eigendecomposition.

Entries become integers ``x = floor(scale * c) + shift`` and stay exact: the sums S of the
fit list are exact decimals, and every use is of ``n * x - S``, centred before anything
is multiplied.

1. Each partition keeps the eigendecomposition of its scatter and applies one centred
   rank-one update per vector.  An update solves the secular equation
   ``1 + sum z_j^2 / (d_j - t) = 0`` for all eigenvalues at once, each as an offset from
   its nearer pole by safeguarded rational steps.  Entries of z that are negligible, and
   equal poles (after a rotation that leaves one entry of z), are deflated: their pairs
   stay.  z is then recomputed from the roots found, so the new vectors are orthogonal to
   working precision.
2. Spectra are combined in a tree of small groups: the pairs of one are rank-one updates
   of the other.  A spectrum is d numbers and a d x d matrix, however many rows it stands
   for, and a task holds two.
3. Rayleigh-Ritz refinement: rows are projected on the basis, the small d x d matrix of
   products is summed over the partitions, and its eigenvectors turn the basis.  This
   repeats (usually once) until the products, measured over all rows, are diagonal to
   ``TOLERANCE``; the identity error reported is that measurement.

Scale: passes over the rows where they lie; what is shuffled is one spectrum or one
matrix per task, combined in groups of ``FAN``; the driver sees d sums and d x d numbers.
An update costs d^3: meant for dimensions up to some hundreds.  A vector that a third of all
rows hold needs no care, since rows are never grouped by value.

Defined results: null vectors and those that hold null, NaN or infinite entries go;
vectors of different lengths are fit lists of their own; empty vectors have no
components; a component whose eigenvalue is 0 to working precision (constant or
dependent dimensions, fewer rows than dimensions) has ``whitened`` null and is left out of
the identity error, which is null if none is left; ``deviation`` is null where it does
not fit a long; entries beyond a long's range are taken as exact integers all the same
(beyond about 1e150 their products leave the range of doubles: an error); null and repeated ids are rows like any other; an empty table gives no rows; extra
columns do not meet the working ones.
"""

from __future__ import annotations

import decimal
import fractions
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import written

TOLERANCE = 1e-11   # off-diagonal products, as correlations
MAX_ROUNDS = 4      # Rayleigh-Ritz rounds; the basis is full, so one does, but for rounding
FAN = 8             # spectra that one task combines
EPS = float(np.finfo(float).eps)
DIRECT = 1 << 40    # integers up to here keep n * x - S apart from rounding in long arithmetic


# --- one rank-one update ---------------------------------------------------------------------

def _roots(d: np.ndarray, z2: np.ndarray) -> np.ndarray:
    """``gap[j, i] = d_j - t_i`` for the roots t_i of 1 + sum z2_j / (d_j - t), d ascending.

    Root i lies between d_i and d_{i+1} (the last below d_n + sum z2).  It is found as an
    offset from the nearer of the two, so that the gaps keep their relative accuracy.
    """
    n = len(d)
    width = np.append(np.diff(d), z2.sum())
    i = np.arange(n)
    diff = d[:, None] - d[None, :]                     # d_j - d_i
    middle = 1.0 + (z2[:, None] / (diff - width / 2)).sum(axis=0)
    right = (middle < 0) & (i < n - 1)                 # nearer to the upper pole
    origin = np.where(right, np.minimum(i + 1, n - 1), i)
    pole = d[:, None] - d[origin][None, :]             # d_j - origin_i
    low = np.where(right, -width / 2, 0.0)
    high = np.where(right, 0.0, np.where(i < n - 1, width / 2, width))
    last = middle[-1] < 0
    low[-1] = width[-1] / 2 if last else 0.0
    high[-1] = width[-1] if last else width[-1] / 2
    t = (low + high) / 2
    lower = i[:, None] <= i[None, :]                   # poles below the root
    upper = np.minimum(i + 1, n - 1)
    for _ in range(60):
        gap = pole - t
        part = z2[:, None] / gap
        f = 1.0 + part.sum(axis=0)
        size = 1.0 + np.abs(part).sum(axis=0)
        done = np.abs(f) <= 8 * EPS * size
        low = np.where(f < 0, t, low)                  # f rises from one pole to the next
        high = np.where(f < 0, high, t)
        if done.all():
            break
        slope = part / gap
        all_slope = slope.sum(axis=0)
        below = np.where(lower, slope, 0.0).sum(axis=0)
        g0, g1 = gap[i, i], gap[upper, i]
        # f is taken as c + a / g0 + b / g1 with the slopes of the two sides kept.
        c = f - g0 * below - g1 * (all_slope - below)
        a = (g0 + g1) * f - g0 * g1 * all_slope
        b = g0 * g1 * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            alone = -f / all_slope                     # the last root has one pole only
        step[-1] = _last_step(f[-1], g0[-1], all_slope[-1], alone[-1])
        new = t + step
        bad = ~np.isfinite(new) | (new <= low) | (new >= high)
        new = np.where(bad, (low + high) / 2, new)
        t = np.where(done, t, new)
        if (np.abs(high - low) <= 2 * EPS * np.maximum(np.abs(low), np.abs(high))).all():
            break
    return pole - t


def _last_step(f: float, g: float, slope: float, newton: float) -> float:
    """Step for the root above all poles: f as r + s / (nearest pole - t)."""
    r = f - g * slope
    if r <= 0:
        return newton
    return g + slope * g * g / r                        # r + s / (g - step) = 0, s = slope g^2


def rank_one(values: np.ndarray, vectors: np.ndarray,
             v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs (ascending, columns) of Q diag(values) Q' + v v'."""
    z = vectors.T @ v
    norm2 = float(z @ z)
    if norm2 == 0.0:
        return values, vectors
    d = values.copy()
    q = vectors
    tol = 8 * EPS * max(abs(float(d[-1])), norm2, abs(float(d[0])))
    norm = np.sqrt(norm2)
    # Equal poles: a reflection within the run leaves the run's whole weight on its last entry.
    close = np.flatnonzero(np.diff(d) <= tol)
    if len(close):
        q = q.copy()
        first = close[np.append(True, np.diff(close) > 1)]
        last = close[np.append(np.diff(close) > 1, True)] + 1
        for a, b in zip(first, last + 1):
            run = z[a:b]
            size = np.sqrt(run @ run)
            if size * norm <= tol:
                continue
            h = run.copy()
            h[-1] += size if h[-1] >= 0 else -size
            h2 = h @ h
            q[:, a:b] -= np.outer(q[:, a:b] @ h, 2.0 / h2 * h)
            lead = -size if run[-1] >= 0 else size
            z[a:b] = 0.0
            z[b - 1] = lead
            d[a:b] = d[a:b].mean()
    live = np.flatnonzero(np.abs(z) * norm > tol)
    if not len(live):
        return values, vectors
    keep, zl = d[live], z[live]
    gap = _roots(keep, zl * zl)
    # The weights for which the roots found are exact.
    diff = keep[:, None] - keep[None, :]
    np.fill_diagonal(diff, 1.0)
    weight = np.sqrt(np.abs(np.prod(gap / diff, axis=1)))
    u = np.copysign(weight, zl)[:, None] / gap
    u /= np.sqrt((u * u).sum(axis=0))
    near = np.argmin(np.abs(gap), axis=0)
    d[live] = keep[near] - gap[near, np.arange(len(live))]
    q = q.copy() if q is vectors else q
    q[:, live] = q[:, live] @ u
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


def combine(a: tuple[np.ndarray, np.ndarray],
            b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of the sum of two scatters: the pairs of one update the other."""
    values, vectors = a
    for value, column in zip(b[0], b[1].T):
        if value > 0:
            values, vectors = rank_one(values, vectors, np.sqrt(value) * column)
    return values, vectors


def empty_spectrum(dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(dims), np.eye(dims)


# --- exact centring --------------------------------------------------------------------------

class Centre:
    """n and the exact sums of the integer entries; gives exact ``n x - S``."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.small = all(abs(s) < 1 << 62 for s in sums)

    def exact(self, x: np.ndarray) -> np.ndarray:
        """n * x - S per row; long, or Python integers where a long might not do."""
        if self.small and x.dtype != object and (
                not x.size or int(np.abs(x).max()) * self.n < 1 << 61):
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n in doubles, rounded once."""
        e = self.exact(x)
        if e.dtype == object:
            return np.array([[float(decimal.Decimal(int(v)) / self.n) for v in r] for r in e],
                            float).reshape(x.shape)
        return e / float(self.n)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of the squares of n x - S per row, exact; None beyond a long."""
        e = self.exact(x)
        if e.dtype != object and (not e.size or
                                  float(np.abs(e).max()) ** 2 * e.shape[1] < 2.0 ** 62):
            return (e * e).sum(axis=1).tolist()
        out = [sum(int(v) * int(v) for v in r) for r in e]
        return [v if v < 1 << 63 else None for v in out]


def integers(batch: pa.RecordBatch, dims: int, scale: float, shift: int) -> np.ndarray:
    """The batch's vectors as integers, one row each."""
    col = batch.column("_v")
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(float)
    with np.errstate(over="ignore"):
        x = np.floor(scale * flat.reshape(-1, dims))
    if not x.size or np.abs(x).max() < DIRECT:
        return x.astype(np.int64) + shift
    exact = fractions.Fraction(scale)
    return np.array([[math.floor(fractions.Fraction(v) * exact) + shift for v in r]
                     for r in flat.reshape(-1, dims).tolist()], object)


# --- distributed steps -----------------------------------------------------------------------

def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """_id, _v (doubles) of the vectors that take part."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return rows.where(x.isNotNull() & (F.size(x) > 0) & ~F.exists(x, odd)).select(
        F.col(f"`{id_col}`").alias("_id"), x.alias("_v"))


def fit_sums(vectors: DataFrame, dims: int, scale: float, shift: int) -> Centre:
    """Exact n and sums; every task sends one row per dimension."""
    def run(batches):
        n, sums = 0, [0] * dims
        for b in batches:
            x = integers(b, dims, scale, shift)
            n += len(x)
            # A batch of entries below 2^40 sums within a long; the total is unbounded.
            sums = [s + int(v) for s, v in zip(sums, x.sum(axis=0))] if len(x) else sums
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()),
             pa.array([str(s) for s in sums])], ["_k", "_n", "_s"])

    parts = vectors.select("_v").mapInArrow(run, "_k int, _n long, _s string")

    def total(f: pd.DataFrame) -> pd.DataFrame:            # one row per task, any size of sum
        return pd.DataFrame({"_k": [f["_k"][0]], "_n": [f["_n"].sum()],
                             "_s": [str(sum(int(s) for s in f["_s"]))]})

    rows = parts.groupBy("_k").applyInPandas(total, "_k int, _n long, _s string").collect()
    rows = sorted(rows, key=lambda r: r._k)
    return Centre(int(rows[0]._n), [int(r._s) for r in rows])


SPECTRUM = "_p long, _values array<double>, _vectors array<double>"


def _pack(p: int, spectrum: tuple[np.ndarray, np.ndarray]) -> dict:
    return {"_p": p, "_values": spectrum[0].tolist(), "_vectors": spectrum[1].ravel().tolist()}


def _unpack(values, vectors) -> tuple[np.ndarray, np.ndarray]:
    d = len(values)
    return np.array(values, float), np.array(vectors, float).reshape(d, d)


def partial_spectra(vectors: DataFrame, centre: Centre, dims: int, scale: float,
                    shift: int) -> DataFrame:
    """One spectrum per partition, by one centred rank-one update per vector."""
    def run(batches):
        spectrum, seen = empty_spectrum(dims), 0
        for b in batches:
            for row in centre.centred(integers(b, dims, scale, shift)):
                spectrum = rank_one(*spectrum, row)
                seen += 1
        if seen:
            yield pa.RecordBatch.from_pylist([_pack(0, spectrum)], pa.schema(
                [("_p", pa.int64()), ("_values", pa.list_(pa.float64())),
                 ("_vectors", pa.list_(pa.float64()))]))

    return vectors.select("_v").mapInArrow(run, SPECTRUM).withColumn(
        "_p", F.shiftright(F.monotonically_increasing_id(), 33))


def combined(spectra: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """All spectra in one, ``FAN`` at a time."""
    def merge(f: pd.DataFrame) -> pd.DataFrame:
        out = empty_spectrum(dims)
        for values, vectors in zip(f["_values"], f["_vectors"]):
            out = combine(out, _unpack(values, vectors))
        return pd.DataFrame([_pack(int(f["_p"][0]), out)])

    level = written(spectra, "whitening-spectra")
    n = level.agg(F.max("_p")).first()[0]
    while n is not None and n > 0:
        n //= FAN
        grouped = level.withColumn("_p", F.expr(f"_p div {FAN}")).repartition(
            int(min(n + 1, 1 << 15)), "_p")
        level = written(grouped.groupBy("_p").applyInPandas(merge, SPECTRUM),
                        "whitening-spectra")
    last = level.first()                                # d + d * d numbers
    return empty_spectrum(dims) if last is None else _unpack(last._values, last._vectors)


def products(vectors: DataFrame, centre: Centre, basis: np.ndarray, scale: float,
             shift: int) -> np.ndarray:
    """Mean of y y' over all rows, y the centred rows projected on ``basis``."""
    dims = basis.shape[0]
    shared = vectors.sparkSession.sparkContext.broadcast(basis)    # d x d numbers

    def run(batches):
        total = np.zeros((dims, dims))
        for b in batches:
            y = centre.centred(integers(b, dims, scale, shift)) @ shared.value
            total += y.T @ y
        up = np.triu_indices(dims)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(up[0]))), pa.array(total[up])], ["_k", "_s"])

    rows = vectors.select("_v").mapInArrow(run, "_k long, _s double").groupBy("_k").agg(
        F.sum("_s").alias("_s")).toArrow()
    out = np.zeros((dims, dims))
    up = np.triu_indices(dims)
    k = rows["_k"].to_numpy()
    out[up[0][k], up[1][k]] = rows["_s"].to_numpy() / centre.n
    return out + np.triu(out, 1).T


class Whitening:
    """A fitted whitening: centre, basis (columns, by falling eigenvalue), measured error."""

    def __init__(self, centre: Centre, values: np.ndarray, basis: np.ndarray, rounds: int,
                 error: float | None, trace: float):
        self.centre, self.values, self.basis = centre, values, basis
        self.rounds, self.error, self.trace = rounds, error, trace

    @property
    def live(self) -> np.ndarray:
        top = self.values[0] if len(self.values) else 0.0
        return self.values > max(top, 0.0) * EPS * len(self.values) * 16


def fit(vectors: DataFrame, dims: int, components: int = 32, scale: float = 64.0,
        shift: int = 1_000_000) -> Whitening:
    """``vectors`` (_id, _v): a written table of vectors of one length."""
    centre = fit_sums(vectors, dims, scale, shift)
    values, basis = combined(partial_spectra(vectors, centre, dims, scale, shift), dims)
    values, basis = values[::-1] / centre.n, basis[:, ::-1]
    basis = np.linalg.qr(basis)[0]
    for rounds in range(1, MAX_ROUNDS + 1):
        h = products(vectors, centre, basis, scale, shift)
        # Measured with the basis and eigenvalues as they stand.
        model = Whitening(centre, values, basis, rounds, None, float(np.trace(h)))
        ok = model.live
        root = np.sqrt(np.where(ok, values, 1.0))
        off = np.abs(h / root[:, None] / root[None, :] - np.eye(dims))
        wide = off[np.ix_(ok, ok)]
        ok[components:] = False
        if ok.any():
            model.error = float(off[np.ix_(ok, ok)].max())
        if not wide.size or wide.max() <= TOLERANCE or rounds == MAX_ROUNDS:
            return model
        e, w = np.linalg.eigh(h)
        basis = np.linalg.qr(basis @ w[:, ::-1])[0]
        values = np.maximum(e[::-1], 0.0)
    return model


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = 32, scale: float = 64.0, shift: int = 1_000_000) -> DataFrame:
    """id, dims, n, deviation, explained, identity_error and the array ``whitened`` (one entry
    per component) of every vector that takes part."""
    spark = rows.sparkSession
    vectors = written(usable(rows, id_col, vector_col), "whitening-vectors")
    id_type = vectors.schema["_id"].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, dims int, n long, deviation long, whitened array<double>, "
              "explained array<double>, identity_error double")
    lengths = sorted(r[0] for r in vectors.select(F.size("_v")).distinct().collect())
    out = spark.createDataFrame([], schema)
    for dims in lengths:                                # one, but for mixed tables
        mine = vectors.where(F.size("_v") == dims)
        model = fit(mine, dims, components, scale, shift)
        out = out.unionByName(mine.mapInArrow(_projection(model, dims, components, scale, shift,
                                                          id_col), schema))
    return out


def _projection(model: Whitening, dims: int, components: int, scale: float, shift: int,
                id_col: str):
    k = min(components, dims)
    live = model.live[:k]
    basis = model.basis[:, :k] / np.sqrt(np.where(live, model.values[:k], 1.0))
    explained = (model.values[:k] / model.trace if model.trace > 0 else np.zeros(k)).tolist()

    def run(batches):
        for b in batches:
            x = integers(b, dims, scale, shift)
            y = model.centre.centred(x) @ basis
            values = pa.array(y.ravel(), mask=np.tile(~live, len(y)))
            n = len(x)
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array([dims] * n, pa.int32()),
                 pa.array([model.centre.n] * n, pa.int64()),
                 pa.array(model.centre.deviation(x), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), values),
                 pa.array([explained] * n, pa.list_(pa.float64())),
                 pa.array([model.error] * n, pa.float64())],
                [id_col, "dims", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def per_component(whitened: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """One row per vector and component, numbered from 1."""
    each = whitened.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias(
        "_at", "_entry"))
    return each.select(F.col(f"`{id_col}`"), (F.col("_at") + 1).alias("component"), "n", "deviation",
                       F.col("_entry.whitened").alias("whitened"),
                       F.col("_entry.explained").alias("explained"), "identity_error")
