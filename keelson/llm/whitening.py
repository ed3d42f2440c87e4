"""Whitening of embeddings from exact integer cross-products, counted by bit-sliced scatter.

Entries become integers in steps of 1/256. The different integer vectors are the fit list. In each
task the list's dimensions are shifted to start at zero and cut into bit planes, one bit a row,
packed into 64-bit words. The cross-product of two dimensions is the sum over their planes of the
ones that both have, times the planes' weights: AND and popcount. The sums of all tasks stay
integers until the covariance is centred, ``n X - S S'``; only then does an eigendecomposition
follow. What reaches the driver grows with the square of the dimension and not with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import stored

#: Steps of an entry's unit; bits and number of the pieces in which exact sums travel.
STEPS, PIECE, PIECES = 256, 30, 6
#: Share of the trace at and below which a direction has no spread.
FLAT = 1e-13


def usable(vector: Column) -> Column:
    """Whether a vector and all its entries are there and finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~bad


def steps(vector: Column) -> Column:
    """Each entry in whole steps, as long; what is beyond a long becomes the nearest one."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * STEPS))


def matrix_of(lists: pa.Array) -> np.ndarray:
    """``(rows, dims)`` of a column of integer lists; zeros follow the shorter ones."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    dims = int(size.max()) if len(size) else 0
    if (size == dims).all():
        return flat.reshape(len(size), dims)
    out = np.zeros((len(size), dims), np.int64)
    out[np.arange(dims) < size[:, None]] = flat
    return out


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(planes, dim, bit)``: packed words of every bit that a dimension of ``y`` (uint64) uses."""
    rows = len(y)
    width = np.array([int(m).bit_length() for m in y.max(axis=0)])
    dim = np.repeat(np.arange(len(width)), width)
    bit = np.arange(len(dim)) - np.repeat(np.cumsum(width) - width, width)
    packed = np.zeros((len(dim), -(-rows // 64) * 8), np.uint8)
    for b in range(width.max(initial=0)):
        own = np.flatnonzero(bit == b)
        ones = ((y[:, dim[own]] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        packed[own, : -(-rows // 8)] = np.packbits(ones, axis=0).T
    return packed.view(np.uint64), dim, bit


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact ``(sums, cross-products)`` of the rows of ``x`` (int64): Python integers, upper triangle."""
    rows, dims = x.shape
    low = x.min(axis=0)
    y = x.view(np.uint64) - low.view(np.uint64)  # exact: the difference of two longs fits unsigned
    planes, dim, bit = bit_planes(y)
    small = 2 * int(bit.max(initial=0)) + rows.bit_length() + 8 < 63
    weight = np.array([1 << int(b) for b in bit], dtype=np.int64 if small else object)
    total = np.zeros(dims, object)
    product = np.zeros((dims, dims), np.int64 if small else object)
    new = np.r_[True, dim[1:] != dim[:-1]] if len(dim) else np.zeros(0, bool)
    for p in range(len(dim)):
        i = dim[p]
        both = np.bitwise_count(planes[p] & planes[p:]).sum(axis=1, dtype=np.int64)
        part = both.astype(weight.dtype) * weight[p:] * weight[p]
        total[i] += int(both[0]) * int(weight[p])
        own = int(np.searchsorted(dim, i, side="right")) - p
        part[1:own] *= 2  # two planes of one dimension meet in both orders
        begin = np.flatnonzero(np.r_[True, new[p + 1 :]])
        product[i, dim[p:][begin]] += np.add.reduceat(part, begin)
    low = low.astype(object)
    product = product.astype(object)
    back = np.outer(low, total)
    return total + rows * low, np.triu(product + back + back.T + rows * np.outer(low, low))


def grown(a: np.ndarray, dims: int) -> np.ndarray:
    """``a`` with zeros up to ``dims`` on every axis, entries as Python integers."""
    out = np.zeros((dims,) * a.ndim, object)
    out[tuple(slice(n) for n in a.shape)] = a
    return out


def _pieces(value: int) -> list[int]:
    """A whole number as short ones, of which only the last may be negative."""
    short = [value >> (PIECE * k) & ((1 << PIECE) - 1) for k in range(PIECES - 1)]
    return [*short, value >> (PIECE * (PIECES - 1))]


def moments(fit: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """``(n, sums, cross-products)`` of ``fit (x)`` as Python integers; the cross-products as a full matrix."""
    names = ["i", "j", *(f"p{k}" for k in range(PIECES))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(0, object), np.zeros((0, 0), object)
        for batch in batches:
            x = matrix_of(batch.column(0))
            if not x.size:
                n += len(x)
                continue
            own, both = scatter(x)
            n, dims = n + len(x), max(len(sums), len(own))
            sums, products = grown(sums, dims) + grown(own, dims), grown(products, dims) + grown(both, dims)
        if n:
            rows = [(-1, -1, n), *((-1, j, s) for j, s in enumerate(sums))]
            rows += [(i, j, products[i, j]) for i in range(len(sums)) for j in range(i, len(sums))]
            columns = zip(*((i, j, *_pieces(int(v))) for i, j, v in rows), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    parts = fit.mapInArrow(count, ", ".join(f"{c} long" for c in names))
    # One row for each two dimensions: bounded by the vectors' length.
    total = parts.groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in names[2:])).collect()
    value = {(r["i"], r["j"]): sum(r[2 + k] << (PIECE * k) for k in range(PIECES)) for r in total}
    dims = 1 + max((j for _, j in value), default=-1)
    sums = np.array([value[-1, j] for j in range(dims)], object)
    products = np.zeros((dims, dims), object)
    for i in range(dims):
        for j in range(i, dims):
            products[i, j] = products[j, i] = value[i, j]
    return value.get((-1, -1), 0), sums, products


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric ``v`` in long doubles.

    ``eigh`` gives the directions; a few Jacobi rotations in the longer format then make small
    eigenvalues beside very large ones as exact as the large ones.
    """
    one = np.longdouble(1)
    q = np.linalg.eigh(v.astype(np.float64))[1].astype(np.longdouble)
    q = q @ (3 * np.eye(len(q), dtype=np.longdouble) - q.T @ q) / 2
    a = q.T @ v @ q
    for _ in range(8):
        scale = np.sqrt(np.abs(np.diag(a)))
        todo = np.argwhere(np.triu(np.abs(a) > 1e-17 * np.outer(scale, scale), 1))
        if not len(todo):
            break
        for i, j in todo:
            if a[i, j] == 0:
                continue
            slope = (a[j, j] - a[i, i]) / (2 * a[i, j])
            t = (one if slope >= 0 else -one) / (abs(slope) + np.sqrt(slope * slope + 1))
            c = one / np.sqrt(t * t + 1)
            turn = np.array([[c, t * c], [-t * c, c]])
            a[:, [i, j]] = a[:, [i, j]] @ turn
            a[[i, j]] = turn.T @ a[[i, j]]
            q[:, [i, j]] = q[:, [i, j]] @ turn
            a[i, j] = a[j, i] = 0
    order = np.argsort(-np.diag(a), kind="stable")
    return np.diag(a)[order], q[:, order]


class Whitening:
    """What a fit list of ``n`` vectors teaches: exact sums, components, eigenvalues, shares of the trace."""

    def __init__(self, n: int, sums: np.ndarray, products: np.ndarray, most: int):
        self.n, self.sums = n, sums
        centred = n * products - np.outer(sums, sums) if n else products
        dims, square = len(sums), n * n
        v = np.array([[np.longdouble(int(c)) / np.longdouble(square) for c in row] for row in centred], np.longdouble)
        values, vectors = eigen(v.reshape(dims, dims)) if dims else (np.zeros(0), np.zeros((0, 0)))
        trace = np.longdouble(int(sum(centred[i, i] for i in range(dims)))) / np.longdouble(max(square, 1))
        keep = min(most, int((values > FLAT * trace).sum()))
        self.values = values[:keep].astype(np.float64)
        self.vectors = np.ascontiguousarray(vectors[:, :keep].astype(np.float64))
        self.share = (values[:keep] / trace).astype(np.float64) if keep else np.zeros(0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exact: longs where they hold it and its squares' sum, else Python integers."""
        dims = len(self.sums)
        most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * self.n
        most += max(map(abs, map(int, self.sums)), default=0)
        kind = np.int64 if most * most * dims < 2**63 else object
        x = np.pad(x, ((0, 0), (0, dims - x.shape[1]))).astype(kind)
        return x * self.n - self.sums.astype(kind)

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        """``(rows, components)``; rounding begins here."""
        return centred.astype(np.float64) / self.n @ self.vectors / np.sqrt(self.values)


def fitted(rows: DataFrame, most: int) -> tuple[Whitening, float]:
    """The whitening of ``rows (x)`` by its different vectors, and its error as measured on them:
    the largest entry of the whitened covariance minus the identity."""
    # Equal vectors meet on the map side first, however many there are.
    fit = stored(rows.select("x").distinct(), "fit-list")
    model = Whitening(*moments(fit), most)
    k = len(model.values)
    if not k:
        return model, 0.0
    names = [f"m{i}" for i in range(k)] + [f"c{i}_{j}" for i in range(k) for j in range(k)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.whiten(model.centred(matrix_of(batch.column(0))))
            first += w.sum(axis=0)
            second += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([float(c)]) for c in (*first, *second.ravel())], names)

    parts = fit.mapInArrow(measure, ", ".join(f"{c} double" for c in names))
    total = np.array(parts.agg(*(F.sum(c) for c in names)).first(), np.float64) / model.n
    covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    return model, float(np.abs(covariance - np.eye(k)).max())


def whitened(
    vectors: DataFrame, most: int = 4, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each vector and component.

    Rows whose vector is null or has null or non-finite entries are left out; a null id is a value
    and repeated rows are all reported. Of vectors of different lengths the shorter are followed by
    zeros, and count as different in the fit list. Directions that hold no more than ``FLAT`` of the
    trace are no components, so equal vectors, a single one or an empty table give no rows.
    ``deviation`` is exact, and null where a long cannot hold it. Other columns are not looked at.
    """
    rows = vectors.where(usable(F.col(vector))).select(
        F.col(id_col).alias("vec_id"), steps(F.col(vector)).alias("x")
    )
    model, error = fitted(rows, most)
    k = len(model.values)
    kind = dict(rows.dtypes)["vec_id"]
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if k else ():
            centred = model.centred(matrix_of(batch.column(1)))
            far = (centred * centred).sum(axis=1).tolist()
            count = len(far)
            far = pa.array([d if d < 2**63 else None for d in far], pa.int64())
            each = pa.array(np.repeat(np.arange(count), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * k, model.n, np.int64)),
                    far.take(each),
                    pa.array(model.whiten(centred).ravel()),
                    pa.array(np.tile(model.share, count)),
                    pa.array(np.full(count * k, error)),
                ],
                names,
            )

    return rows.mapInArrow(
        project,
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double",
    )
