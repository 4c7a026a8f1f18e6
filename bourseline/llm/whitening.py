"""Whitening of embeddings: blockwise QR, Householder bidiagonalisation, singular values by dqds,
directions from twisted factorisations.

1. Every entry c becomes the whole number floor(64 * c) + 1000000. The fit list holds each distinct
   vector of such numbers once; its sums are exact.
2. Tasks centre their rows and reduce them to triangles R (QR of the triangle so far and the next
   block); triangles of tasks are joined by QR in a tree, until one is left, whatever the corpus holds.
3. On that small triangle, Householder reflections from both sides give a bidiagonal matrix.
4. dqds (differential quotient-difference with shifts) finds its singular values: a sweep without
   shift tells the trace of the inverse, whose reciprocal is a bound below the smallest value and so
   a safe shift of the next sweep. No sum has a subtraction of unlike signs but that of the shift, so
   small values come out as exactly as large ones.
5. For each value, a twisted factorisation (stationary from the top, progressive from the bottom, joined
   where they differ least) gives its singular vector without iteration. Vectors of values that agree to
   `CLOSE` are made orthogonal among themselves.

Nothing forms a covariance to find directions, so none is lost to squaring.

Cases: a vector that is null or holds null or non-finite entries takes no part, nor does one of no entries;
vectors of each dimension are fitted and whitened for themselves; rows with null or repeated keys are rows
like any other; components whose variance is zero (at most `FLAT` of the largest singular value) cannot be
whitened and are left out, as are those beyond the dimension, so a single distinct vector gives no rows; an
empty table gives an empty result; a deviation beyond 64 bits is null; only the named columns are read, so
extra columns cannot clash. An entry must stay below 2^46 in size, so that sums are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourseline.sources.storage import stage

GRID, OFFSET = 64, 1_000_000
COMPONENTS = 16
ROWS = 4096  # rows of a block
FAN = 32  # triangles joined at a time
EPS = 2.0**-52
CLOSE = 1e-5  # relative gap of squared singular values below which vectors are made orthogonal
FLAT = 1e-12


@dataclass
class Whitening:
    n: int  # vectors of the fit list
    sums: np.ndarray  # exact, by entry
    directions: np.ndarray  # a column for each component, unit length
    variances: np.ndarray  # by component, falling
    trace: float  # sum of all variances
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return (_deviations(x, self.n, self.sums) / self.n) @ self.directions / np.sqrt(self.variances)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums as doubles, exact where it fits in 53 bits; the mean's whole part goes first, so that nothing overflows."""
    whole, rest = sums // n, sums % n
    return (x - whole).astype(np.float64) * n - rest


def _exact_squares(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum of (n * x - sums)^2 over the entries of each row; null beyond 64 bits."""
    rough = (_deviations(x, n, sums) ** 2).sum(axis=1)
    if rough.size and rough.max() < 2.0**62:
        d = (x - sums // n) * n - sums % n
        return (d * d).sum(axis=1).tolist()
    out: list[int | None] = []
    for row in x.tolist():
        total = sum((n * v - s) ** 2 for v, s in zip(row, sums.tolist()))
        out.append(total if total < 1 << 63 else None)
    return out


def _matrices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of 64-bit numbers) for each dimension in the batch."""
    raw = batch.column(column)
    sizes = np.asarray(pc.binary_length(raw)) // 8
    for d in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == d)
        joined = b"".join(raw.take(pa.array(rows)).to_pylist())
        for at in range(0, len(rows), ROWS):
            some = rows[at : at + ROWS]
            yield some, np.frombuffer(joined, dtype="<i8", count=len(some) * d, offset=at * d * 8).reshape(-1, d)


def on_grid(vectors: DataFrame, key: str, column: str, grid: int = GRID, offset: int = OFFSET) -> DataFrame:
    """`key` and `x`, the vector's whole numbers as little-endian 64-bit integers, of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
            flat = pc.list_flatten(lists)
            values = np.asarray(flat.cast(pa.float64()).fill_null(float("nan")))
            ends = np.cumsum(sizes)
            fine = sizes > 0
            bad = np.flatnonzero(~np.isfinite(values))
            fine[np.searchsorted(ends, bad, side="right")] = False
            values = np.where(np.isfinite(values), values, 0.0)
            x = (np.floor(grid * values) + offset).astype("<i8").tobytes()
            rows = np.flatnonzero(fine)
            out = [x[8 * (e - s) : 8 * e] for e, s in zip(ends[rows].tolist(), sizes[rows].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(out, pa.binary())], names=[key, "x"])

    kind = vectors.schema[key].dataType.simpleString()
    return vectors.select(key, column).mapInArrow(run, f"`{key}` {kind}, x binary")


def _sums(fit_list: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """For each dimension the number of vectors and the exact sum of every entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for rows, x in _matrices(batch, 0):
                d = x.shape[1]
                counts[d] = counts.get(d, 0) + len(rows)
                totals[d] = totals.get(d, 0) + x.sum(axis=0)
        if counts:
            dims = np.concatenate([np.full(d, d) for d in counts])
            places = np.concatenate([np.arange(d) for d in counts])
            ns = np.concatenate([np.full(d, n) for d, n in counts.items()])
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (dims, places, ns, np.concatenate(list(totals.values())))], names=["d", "place", "n", "total"])

    found = fit_list.select("x").mapInArrow(run, "d long, place long, n long, total long").groupBy("d", "place")
    found = found.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("d", "place")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in found.collect():  # a row for each entry of a vector
        out.setdefault(r["d"], (r["n"], []))[1].append(r["total"])
    return {d: (n, np.array(total, dtype=np.int64)) for d, (n, total) in out.items()}


def _triangle(above: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if above is None else np.vstack([above, rows]), mode="r")


def _reduced(fit_list: DataFrame, sums: dict[int, tuple[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """For each dimension a triangle R with R'R equal to the sum of squares of the centred rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _matrices(batch, 0):
                n, total = sums[x.shape[1]]
                found[x.shape[1]] = _triangle(found.get(x.shape[1]), _deviations(x, n, total) / n)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([r.tobytes() for r in found.values()], pa.binary())], names=["d", "r"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[d] = _triangle(found.get(d), np.frombuffer(raw, dtype=np.float64).reshape(-1, d))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([r.tobytes() for r in found.values()], pa.binary())], names=["d", "r"])

    schema = "d long, r binary"
    triangles = stage(fit_list.select("x").mapInArrow(run, schema), "triangles")
    left = triangles.count()
    while left > FAN * len(sums):
        triangles = stage(triangles.repartition(-(-left // FAN)).mapInArrow(joined, schema), "triangles")
        left, before = triangles.count(), left
        if left >= before:
            break
    out: dict[int, np.ndarray] = {}
    for r in triangles.orderBy("d", F.xxhash64("r")).collect():  # some FAN triangles of each dimension
        out[r["d"]] = _triangle(out.get(r["d"]), np.frombuffer(bytes(r["r"]), dtype=np.float64).reshape(-1, r["d"]))
    return out


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, right factor P) of a square matrix r = Q B P' by Householder reflections."""
    a = np.array(r, dtype=np.float64)
    d = a.shape[0]
    right = np.eye(d)
    for k in range(d):
        for rows in (True, False):
            v = a[k:, k].copy() if rows else a[k, k + 1 :].copy()
            if len(v) < 2:
                continue
            size = np.linalg.norm(v)
            if size == 0:
                continue
            v[0] += math.copysign(size, v[0])
            v /= np.linalg.norm(v)
            if rows:
                a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
            else:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
                right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One dqds transform: the squares of the next bidiagonal factor and the d of the sweep; None if the shift was too large."""
    d = q[0] - shift
    nq, ne, ds = [], [], [d]
    for i in range(len(e)):
        if d < 0:
            return None
        top = d + e[i]
        ratio = q[i + 1] / top if top > 0 else math.inf
        if not math.isfinite(ratio):
            # A zero on the diagonal: the row decouples.
            nq.append(0.0)
            ne.append(0.0)
            d = q[i + 1] - shift
        else:
            nq.append(top)
            ne.append(e[i] * ratio)
            d = d * ratio - shift
        ds.append(d)
    if d < 0:
        return None
    nq.append(d)
    return nq, ne, ds


def dqds(diagonal: np.ndarray, super_: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    out: list[float] = []
    blocks = [([float(v) ** 2 for v in diagonal], [float(v) ** 2 for v in super_], 0.0)]  # squares, and the shifts so far
    while blocks:
        q, e, past = blocks.pop()
        while q:
            if len(q) == 1:
                out.append(past + q.pop())
                break
            # Off-diagonal squares too small to move any value part the block.
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (past + min(q[i], q[i + 1])) or e[i] <= 1e-290), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], past))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if q[0] < q[-1]:  # the small end belongs below; turned over, a bidiagonal matrix keeps its values
                q.reverse()
                e.reverse()
            q, e, ds = _sweep(q, e, 0.0)
            # The sum of 1 / d is the trace of the inverse of the squares.
            bound = 0.0 if min(ds) <= 0 else 1 / sum(1 / v for v in ds)
            shift = bound * (1 - 4 * len(q) * EPS)
            while shift > EPS * past:
                moved = _sweep(q, e, shift)
                if moved is not None:
                    q, e, past = moved[0], moved[1], past + shift
                    break
                shift *= 0.5
    return np.sort(np.array(out))[::-1]


def twisted(diagonal: np.ndarray, super_: np.ndarray, value: float, skip: int = 0) -> np.ndarray:
    """The right singular vector of the bidiagonal matrix for a squared singular value: L D L' - value is factored from
    the top (L+ D+ L+') and from the bottom (U- D- U-'), joined at the place where the pivot is smallest (or the
    `skip`th smallest)."""
    q, e = diagonal**2, super_**2
    n = len(q)
    tiny = np.finfo(float).tiny / EPS
    lower, upper = np.empty(n), np.empty(n)
    s, p = np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        top = s[i] + q[i]
        top = top if abs(top) > tiny else math.copysign(tiny, top)
        lower[i] = diagonal[i] * super_[i] / top
        s[i + 1] = s[i] * (e[i] / top) - value
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        low = e[i] + p[i + 1]
        low = low if abs(low) > tiny else math.copysign(tiny, low)
        upper[i] = diagonal[i] * super_[i] / low
        p[i] = p[i + 1] * (q[i] / low) - value
    pivot = np.abs(s + p + value)
    k = int(np.argsort(np.where(np.isfinite(pivot), pivot, np.inf), kind="stable")[min(skip, n - 1)])
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -upper[i] * z[i]
    z[~np.isfinite(z)] = 0.0
    return z / np.linalg.norm(z)


def _blocks(diagonal: np.ndarray, super_: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of the matrix that no superdiagonal entry of weight joins."""
    size = max(np.abs(diagonal).max(initial=0.0), np.abs(super_).max(initial=0.0))
    begin = 0
    for i in range(len(diagonal)):
        if i + 1 == len(diagonal) or abs(super_[i]) <= EPS * size:
            yield begin, i + 1
            begin = i + 1


def singular(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` largest singular values of a square matrix, squared and falling, and their right vectors as columns."""
    diagonal, super_, right = bidiagonal(r)
    found: list[tuple[float, int, int]] = []
    for begin, end in _blocks(diagonal, super_):
        found += [(v, begin, end) for v in dqds(diagonal[begin:end], super_[begin : end - 1])]
    found.sort(key=lambda x: -x[0])
    values = np.array([x[0] for x in found])
    keep = int(min(most, (values > FLAT**2 * values[0]).sum())) if len(values) and values[0] > 0 else 0
    columns: list[np.ndarray] = []
    for k, (value, begin, end) in enumerate(found[:keep]):
        near = [j for j in range(k) if found[j][1] == begin and found[j][0] - value <= CLOSE * found[j][0]]
        for skip in range(end - begin):
            z = np.zeros(len(diagonal))
            z[begin:end] = twisted(diagonal[begin:end], super_[begin : end - 1], value, skip)
            for _ in range(2):
                for j in near:
                    z -= (z @ columns[j]) * columns[j]
            if np.linalg.norm(z) > 1e-3:
                break
        columns.append(z / np.linalg.norm(z))
    return values[:keep], right @ np.array(columns).T if columns else np.empty((len(diagonal), 0))


def _identity_errors(fit_list: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """The largest entry of the whitened fit list's covariance minus the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _matrices(batch, 0):
                w = models[x.shape[1]].project(x)
                found[x.shape[1]] = found.get(x.shape[1], 0) + w.T @ w
        for d, total in found.items():
            k = total.shape[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in (np.full(k * k, d), np.repeat(np.arange(k), k), np.tile(np.arange(k), k), total.ravel())], names=["d", "i", "j", "total"]
            )

    sums = fit_list.select("x").mapInArrow(run, "d long, i long, j long, total double").groupBy("d", "i", "j").agg(F.sum("total").alias("total"))
    out = dict.fromkeys(models, 0.0)
    for r in sums.collect():  # the square of the number of components
        out[r["d"]] = max(out[r["d"]], abs(r["total"] / models[r["d"]].n - (r["i"] == r["j"])))
    return out


def train(gridded: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """A whitening for each dimension, from the distinct vectors `x` of `on_grid`."""
    fit_list = stage(gridded.select("x").distinct(), "fit-list")
    sums = _sums(fit_list)
    models = {}
    for d, r in _reduced(fit_list, sums).items():
        n, total = sums[d]
        square = np.zeros((d, d))
        square[: r.shape[0]] = r
        values, directions = singular(square, components)
        models[d] = Whitening(n, total, directions, values / n, float((r * r).sum()) / n)
    for d, error in _identity_errors(fit_list, models).items():
        models[d].identity_error = error
    return models


def whiten(gridded: DataFrame, models: dict[int, Whitening], key: str) -> DataFrame:
    """For each row and component: `key`, `component` (from 1), `n`, `deviation`, `whitened`, `explained`, `identity_error`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _matrices(batch, 1):
                m = models[x.shape[1]]
                k = len(m.variances)
                columns = [
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), pa.array(np.full(len(rows) * k, m.n, dtype=np.int64)),
                    pa.array(_exact_squares(x, m.n, m.sums), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                    pa.array(m.project(x).ravel()), pa.array(np.tile(m.variances / m.trace if k else m.variances, len(rows))),
                    pa.array(np.full(len(rows) * k, m.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(rows, k))), *columns], names=names)

    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kind = gridded.schema[key].dataType.simpleString()
    return gridded.mapInArrow(run, f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
