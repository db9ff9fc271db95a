"""Whitening of vectors by a covariance that is put together from variances (polarisation).

Every component c becomes the integer x = floor(scale * c); a constant added to all x
cancels out of every centred value. The fit list holds each distinct x vector once: n
vectors with sums S per dimension, so n*x - S is an exact, centred integer.

1. Fit list: the x vectors, packed to as few bytes as they need, made distinct and written.
2. One pass gives n and S, a second one the exact sums of squares of the centred values of
   every dimension and of every sum of two dimensions. As
   ``2 cov(i, j) = var(i + j) - var(i) - var(j)``, differences of those recover all
   cross-covariances, still as integers; ``eigh`` gets their correctly rounded quotients.
3. A third pass measures the covariance of the whitened fit list.
4. Every row is projected: no row moves, and only sums (width squared) reach the driver.

Squares are summed in two halves of 24 bits, so int64 sums are exact; Spark adds the
partial sums as decimals.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries are
dropped; rows with a null id and repeated rows are kept; vectors of different lengths are
fitted apart, and the identity error is the largest of all; shorter vectors than ``top``
give as many components as they have; components without variance (fewer distinct vectors
than dimensions, a single vector) have a null whitened value and take no part in the
identity error; ``explained`` is 0 when nothing varies; an empty table gives an empty
result; columns other than id and vector are not looked at. A row whose exact deviation
does not fit a long raises ``OverflowError``, as does a fit of more than ``MAX_CELLS``
covariances.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import pick, ship, staged

SCALE = 64
TOP = 16
MAX_CELLS = 1 << 24  # width squared, summed over the lengths that occur: what the driver gets
LARGEST = 2.0**40  # scaled components beyond this are refused
HALF = 24
NO_VARIANCE = 1e-13  # eigenvalues below this share of the largest are rounding errors of zero
_TOTAL = T.DecimalType(38, 0)


@dataclass(frozen=True)
class Fit:
    """Whitening of vectors of one length: ``axes`` holds the unit eigenvectors as columns, by falling eigenvalue."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    axes: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n*x - S as exact integers."""
        spread = np.abs(self.n * x.astype(np.float64) - self.sums.astype(np.float64))
        if spread.size and (spread * spread).sum(axis=1).max() >= 2.0**62:
            raise OverflowError("the squared deviation of a vector does not fit a long")
        return self.n * x - self.sums

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        """Projections of x - S/n on the axes over the standard deviations; NaN without variance."""
        usable = self.values > max(self.values.max(initial=0.0) * NO_VARIANCE, 0.0)
        scale = np.where(usable, np.sqrt(np.where(usable, self.values, 1.0)), np.nan)
        return (centred / self.n) @ self.axes / scale


@dataclass(frozen=True)
class Model:
    fits: dict[int, Fit]
    identity_error: float


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows whose vector has only finite entries, v as array of doubles."""
    rows = pick(vectors, id_col, vector_col).select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(~odd, F.lit(False)))


def _by_width(column: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, integer vectors) of each length that occurs in a list column."""
    widths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(widths)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        scaled = np.floor(scale * flat[(ends[at] - width)[:, None] + np.arange(width)])
        if np.abs(scaled).max() > LARGEST:
            raise OverflowError(f"a component is beyond {LARGEST / scale:g}")
        yield at, scaled.astype(np.int64)


def _packed(x: np.ndarray) -> list[bytes]:
    """Every vector in the smallest integer type that holds it; equal vectors give equal bytes."""
    low, high = x.min(axis=1), x.max(axis=1)
    out: list[bytes] = [b""] * len(x)
    left = np.ones(len(x), bool)
    for kind in (np.int8, np.int16, np.int32, np.int64):
        here = left & (low >= np.iinfo(kind).min) & (high <= np.iinfo(kind).max)
        left &= ~here
        narrow = x[here].astype(kind)
        for k, row in zip(np.flatnonzero(here), narrow):
            out[k] = row.tobytes()
    return out


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Vectors of the columns (width, x) of the fit list, together where width and type agree."""
    groups: dict[tuple[int, int], list[bytes]] = {}
    for width, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        groups.setdefault((width, len(data)), []).append(data)
    for (width, size), rows in groups.items():
        yield width, np.frombuffer(b"".join(rows), f"<i{size // width}").reshape(-1, width).astype(np.int64)


def fit_list(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(width, x): every distinct integer vector once, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths, packed = np.zeros(batch.num_rows, np.int32), [b""] * batch.num_rows
            for at, x in _by_width(batch.column(0), scale):
                widths[at] = x.shape[1]
                for k, data in zip(at, _packed(x)):
                    packed[k] = data
            yield pa.RecordBatch.from_arrays([pa.array(widths), pa.array(packed, pa.binary())], names=["width", "x"])

    rows = usable(vectors, id_col, vector_col).select("v")
    return staged(rows.mapInArrow(run, "width int, x binary").distinct())


def _collected(fit: DataFrame, names: list[str], totals: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]], value: T.DataType) -> list:
    """Sums of ``value`` over the tasks, per key ``names``: ``totals`` yields (key..., value) per task."""
    schema = T.StructType([*(T.StructField(n, T.IntegerType()) for n in names), T.StructField("value", value)])
    kind = pa.decimal128(38, 0) if isinstance(value, T.DecimalType) else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = list(zip(*totals(batches)))
        if columns:
            *keys, values = columns
            yield pa.RecordBatch.from_arrays([*(pa.array(k, pa.int32()) for k in keys), pa.array(values, kind)], names=schema.names)

    return fit.mapInArrow(run, schema).groupBy(*names).agg(F.sum("value").alias("value")).collect()


def _sums(fit: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """n and the sums per dimension, of every length. Dimension -1 counts."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, x in _unpacked(batch):
                add = np.append(x.sum(axis=0), len(x)).astype(object)
                found[width] = found.get(width, 0) + add
        for width, sums in found.items():
            yield from ((width, d if d < width else -1, Decimal(int(s))) for d, s in enumerate(sums))

    out: dict[int, dict[int, int]] = {}
    for row in _collected(fit, ["width", "dim"], totals, _TOTAL):
        out.setdefault(row["width"], {})[row["dim"]] = int(row["value"])
    return {w: (d[-1], np.array([d[k] for k in range(w)], np.int64)) for w, d in out.items()}


def squares(centred: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(i, exact sums of squares) of dimension i (first) and of its sums with each later dimension."""
    for i in range(centred.shape[1]):
        both = centred[:, i:] + centred[:, i : i + 1]
        both[:, 0] = centred[:, i]
        high, low = both >> HALF, both & ((1 << HALF) - 1)
        parts = (np.einsum("rc,rc->c", a, b).astype(object) for a, b in ((high, high), (high, low), (low, low)))
        hh, hl, ll = parts
        yield i, hh * (1 << 2 * HALF) + hl * (1 << HALF + 1) + ll


def _moments(fit: DataFrame, known: dict[int, Fit]) -> dict[int, np.ndarray]:
    """Sums of squares by (i, j) of every length: dimension i where i = j, else the sum of i and j."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for width, x in _unpacked(batch):
                for at in range(0, len(x), 1 << 12):
                    for i, sums in squares(known[width].centred(x[at : at + (1 << 12)])):
                        found[width, i] = found.get((width, i), 0) + sums
        for (width, i), sums in found.items():
            yield from ((width, i, i + k, Decimal(int(s))) for k, s in enumerate(sums))

    out = {w: np.zeros((w, w), object) for w in known}
    for row in _collected(fit, ["width", "i", "j"], totals, _TOTAL):
        out[row["width"]][row["i"], row["j"]] = int(row["value"])
    return out


def covariance(moments: np.ndarray, n: int) -> np.ndarray:
    """Covariances of x from the integer sums of squares of n*x - S."""
    width = len(moments)
    out = np.zeros((width, width))
    for i in range(width):
        out[i, i] = int(moments[i, i]) / n**3
        for j in range(i + 1, width):
            out[i, j] = out[j, i] = (int(moments[i, j]) - int(moments[i, i]) - int(moments[j, j])) / (2 * n**3)
    return out


def _axes(n: int, sums: np.ndarray, moments: np.ndarray, top: int) -> Fit:
    values, vectors = np.linalg.eigh(covariance(moments, n))
    trace = sum(int(moments[i, i]) for i in range(len(moments))) / n**3
    values, vectors = values[::-1][:top], vectors[:, ::-1][:, :top]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    explained = np.maximum(values, 0.0) / trace if trace else np.zeros(len(values))
    return Fit(n, sums, values, vectors * np.where(largest < 0, -1.0, 1.0), explained)


def _identity_error(fit: DataFrame, fits: dict[int, Fit]) -> float:
    """Largest entry of the covariance of the whitened fit list minus the identity, measured."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, x in _unpacked(batch):
                z = fits[width].whiten(fits[width].centred(x))
                found[width] = found.get(width, 0) + np.vstack([z.T @ z, z.sum(axis=0)])
        for width, sums in found.items():
            yield from ((width, i, j, float(s)) for (i, j), s in np.ndenumerate(sums) if np.isfinite(s))

    worst = 0.0
    gathered: dict[int, dict[tuple[int, int], float]] = {}
    for row in _collected(fit, ["width", "i", "j"], totals, T.DoubleType()):
        gathered.setdefault(row["width"], {})[row["i"], row["j"]] = row["value"]
    for width, sums in gathered.items():
        n, last = fits[width].n, len(fits[width].values)
        for (i, j), total in sums.items():
            if i < last:  # whitened values are centred already: their means are rounding errors
                entry = total / n - (sums[last, i] / n) * (sums[last, j] / n)
                worst = max(worst, abs(entry - (i == j)))
    return worst


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, top: int = TOP) -> Model:
    """Whitening fitted on the distinct integer vectors of all usable rows."""
    ship(vectors.sparkSession)
    listed = fit_list(vectors, id_col, vector_col, scale)
    sums = _sums(listed)
    if sum(w * w for w in sums) > MAX_CELLS:
        raise OverflowError(f"more than {MAX_CELLS} covariances")
    bare = {w: Fit(n, s, np.zeros(0), np.zeros((w, 0)), np.zeros(0)) for w, (n, s) in sums.items()}
    moments = _moments(listed, bare)
    fits = {w: _axes(n, s, moments[w], top) for w, (n, s) in sums.items()}
    return Model(fits, _identity_error(listed, fits))


def whiten(
    vectors: DataFrame, model: Model, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """One row per usable row: id, n, deviation, and the arrays whitened and explained by component."""
    ship(vectors.sparkSession)
    rows = usable(vectors, id_col, vector_col)
    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["id"].dataType), T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()), T.StructField("whitened", doubles), T.StructField("explained", doubles),
        ]
    )
    fits = model.fits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, x in _by_width(batch.column(1), scale):
                one = fits[x.shape[1]]
                centred = one.centred(x)
                flat = one.whiten(centred).ravel()
                offsets = pa.array(np.arange(len(at) + 1, dtype=np.int32) * len(one.values))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(at)),
                        pa.array(np.full(len(at), one.n)),
                        pa.array(np.einsum("rc,rc->r", centred, centred)),
                        pa.ListArray.from_arrays(offsets, pa.array(flat, mask=np.isnan(flat))),
                        pa.ListArray.from_arrays(offsets, pa.array(np.tile(one.explained, len(at)))),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)
