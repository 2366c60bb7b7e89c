"""Whitening of embeddings by a covariance from sums of squares alone (polarisation)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxloom.session import release, settle

#: Vectors worked on at once; bits of a limb, so that sums of products of limbs over a block fit 64 bits.
BLOCK, LIMB = 1024, 25
#: Bits of the parts in which exact sums travel: over 2 to the 22 tasks' parts still fit 64 bits.
PART = 40
#: Components beyond this are no whole numbers a double holds.
LARGEST = float(1 << 52)


def whole(embedding: Column, scale: int = 256) -> Column:
    """Components as whole numbers, rounded down; NULL for vectors that are NULL or hold one that is NULL, not finite or too large."""
    real = F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * F.lit(float(scale))) < F.lit(LARGEST)))
    return F.when(fine, F.transform(real, lambda x: x.cast("long")))


def vectors(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of a batch by length: rows' numbers and a matrix."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat, ends = lists.flatten().to_numpy(), np.cumsum(lengths)
    for dim in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dim)
        for k in range(0, len(rows), BLOCK):
            some = rows[k : k + BLOCK]
            yield some, flat[(ends[some] - dim)[:, None] + np.arange(dim)]


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """``y`` as parts of ``LIMB`` bits, lowest first; the last one has the sign."""
    out = []
    most = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
    while most >> LIMB:
        out.append((y & (1 << LIMB) - 1).astype(np.int64))
        y, most = y >> LIMB, most >> LIMB
    return [*out, y.astype(np.int64)]


def squares(y: np.ndarray) -> list[int]:
    """Exact sums of squares of the columns of whole numbers, of any size."""
    parts = limbs(y)
    out = np.zeros(y.shape[1], object)
    for a, one in enumerate(parts):
        for b, two in enumerate(parts):
            out += (one * two).sum(0).astype(object) << LIMB * (a + b)
    return out.tolist()


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums``, in Python's whole numbers if 62 bits don't hold it."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(map(abs, sums.tolist()), default=0)
    return (x * n if most < 1 << 61 else x.astype(object) * n) - (sums.astype(np.int64) if most < 1 << 61 else sums)


def sent(dim: int, at: list[int], totals: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """Sums cut into parts of ``PART`` bits; the sign stays with the last one."""
    for place, total in zip(at, totals, strict=True):
        k = 0
        while total and not -(1 << PART) < total < 1 << PART:
            yield dim, place, k, total & (1 << PART) - 1
            total, k = total >> PART, k + 1
        yield dim, place, k, total


SENT = "dim int, at bigint, part int, n bigint"


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["dim", "at", "part", "n"])


def gathered(parts: DataFrame) -> dict[int, dict[int, int]]:
    """Exact totals by dimension and place; as many come to the driver as a vector has pairs of dimensions."""
    out: dict[int, dict[int, int]] = {}
    for dim, at, part, n in parts.groupBy("dim", "at", "part").agg(F.sum("n")).collect():
        held = out.setdefault(dim, {})
        held[at] = held.get(at, 0) + (n << PART * part)
    return out


def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per dimension the sum of a task's vectors; their number is at place -1."""
    held: dict[int, list[int]] = {}
    for batch in batches:
        for _, x in vectors(batch.column(0)):
            own = held.setdefault(x.shape[1], [0] * (x.shape[1] + 1))
            # Below 2 to the 52 each, so a block's sum fits.
            for k, total in enumerate([len(x), *x.sum(0).tolist()]):
                own[k] += total
    yield as_batch([r for dim, own in held.items() for r in sent(dim, range(-1, dim), own)])


def polarised(batches: Iterator[pa.RecordBatch], means: dict[int, tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """A task's exact sums of ``c_i ** 2`` and of ``(c_i + c_j) ** 2``, for centred values c and each i < j, at place ``i * dim + j``."""
    held: dict[int, list[list[int]]] = {}
    for batch in batches:
        for _, x in vectors(batch.column(0)):
            dim = x.shape[1]
            c = centred(x, *means[dim])
            rows = held.setdefault(dim, [[0] * (dim - i) for i in range(dim)])
            for i in range(dim):
                y = c[:, i:] + c[:, i : i + 1]
                y[:, 0] = c[:, i]
                rows[i] = [a + b for a, b in zip(rows[i], squares(y), strict=True)]
    yield as_batch([r for dim, rows in held.items() for i, own in enumerate(rows) for r in sent(dim, range(i * dim + i, i * dim + dim), own)])


@dataclass(frozen=True)
class Whitening:
    """What vectors of one length are whitened by: directions are rows, by falling variance."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n * x - S) ** 2`` per vector, exact; None beyond 63 bits."""
        return [t if t < 1 << 63 else None for t in squares(centred(x, self.n, self.sums).T)]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Projections of the centred vectors over their standard deviations; NaN along directions without variance."""
        with np.errstate(invalid="ignore", divide="ignore"):
            return (centred(x, self.n, self.sums).astype(np.float64) / self.n) @ self.directions.T / np.where(self.variances > 0, np.sqrt(self.variances), np.nan)


def covariance(dim: int, n: int, found: dict[int, int]) -> tuple[np.ndarray, float]:
    """Covariances and their trace: half of what the variance of a sum of two dimensions exceeds the sum of their own ones."""
    out = np.zeros((dim, dim))
    own = [found[i * dim + i] for i in range(dim)]
    for i in range(dim):
        for j in range(i, dim):
            # Whole numbers up to here; one division, rounded once.
            twice = 2 * own[i] if i == j else found[i * dim + j] - own[i] - own[j]
            out[i, j] = out[j, i] = twice / (2 * n**3)
    return out, sum(own) / n**3


def fit(distinct: DataFrame, components: int) -> dict[int, Whitening]:
    """The whitening of each length of vectors in ``distinct`` (``x``, each once)."""
    sums = gathered(distinct.mapInArrow(totals, SENT))
    means = {dim: (held[-1], np.array([held[i] for i in range(dim)], object)) for dim, held in sums.items()}
    found = gathered(distinct.mapInArrow(lambda it: polarised(it, means), SENT))
    out = {}
    for dim, (n, total) in means.items():
        v, trace = covariance(dim, n, found[dim])
        values, columns = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:components]
        rows = columns.T[order]
        rows *= np.where(rows[np.arange(len(rows)), np.abs(rows).argmax(1)] < 0, -1.0, 1.0)[:, None]
        # A value that rounding alone can make is none.
        values = np.where(values[order] > max(values.max(initial=0), 0) * dim * np.finfo(float).eps, values[order], 0.0)
        out[dim] = Whitening(n, total, rows, values, values / trace if trace else np.full(len(values), np.nan))
    return out


def identity_errors(distinct: DataFrame, fitted: dict[int, Whitening]) -> dict[int, float]:
    """Per length the largest entry of the covariance of the whitened fit list minus the identity, measured over that list."""
    most = max((len(w.variances) for w in fitted.values()), default=0)
    columns = [f"w{k}" for k in range(most)]

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in vectors(batch.column(0)):
                w = np.zeros((len(x), most))
                own = fitted[x.shape[1]].whitened(x)
                w[:, : own.shape[1]] = own
                w[np.isnan(w)] = 0.0
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), x.shape[1]), pa.int32()), *map(pa.array, w.T)], ["dim", *columns])

    if not most:
        return {}
    held = distinct.mapInArrow(projected, ", ".join(["dim int", *[f"{c} double" for c in columns]]))
    pairs = [(a, b) for a in range(most) for b in range(a, most)]
    out = {}
    for row in held.groupBy("dim").agg(*[F.covar_pop(columns[a], columns[b]) for a, b in pairs]).collect():
        real = fitted[row[0]].variances > 0
        errors = [abs(v - (a == b)) for (a, b), v in zip(pairs, row[1:], strict=True) if max(a, b) < len(real) and real[a] and real[b]]
        out[row[0]] = max(errors, default=0.0)
    return out


def whiten(embeddings: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """Whitened components of each vector: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Vectors become whole numbers x, ``floor(scale * c)``. The fit list is every
    distinct x once; its sums and all sums of squares are exact, whatever their
    size: they are added in whole numbers and come to the driver as one number
    a pair of dimensions. ``deviation`` is exact as well, NULL beyond 63 bits.
    Components are unit eigenvectors of the covariance by falling variance,
    their largest entry positive; ``whitened`` is the projection of a vector
    less the mean over the component's standard deviation. ``explained`` is a
    component's share of all variance, ``identity_error`` measured over the
    whitened fit list.

    Vectors that are NULL, or hold a component that is NULL, not finite or
    2 to the 52 and more times ``1 / scale``, are left out. Vectors of each length are
    whitened by themselves; empty ones give no rows, others as many components
    as they have, at most ``components``. A component without variance (one
    vector, equal ones) has NULL ``whitened``, and NULL ``explained`` if there is no
    variance at all. Repeated rows and NULL or repeated vec_ids give rows each.
    Other columns don't matter; an empty table gives an empty result.
    """
    held = settle(embeddings.select("vec_id", whole(F.col("embedding"), scale).alias("x")).where("x is not null and size(x) > 0"))
    # Copies meet in one row before they move, so a vector in a third of all rows is no load.
    distinct = settle(held.select("x").distinct())
    fitted = fit(distinct, components)
    errors = identity_errors(distinct, fitted)
    release(distinct)
    kind = held.schema["vec_id"].dataType.simpleString()
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in vectors(batch.column(1)):
                of = fitted[x.shape[1]]
                k = len(of.variances)
                repeated = np.repeat(np.arange(len(x)), k)
                real = lambda v: pa.array(v, from_pandas=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows[repeated])),
                        pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                        pa.array(np.full(len(repeated), of.n), pa.int64()),
                        pa.array(of.deviation(x), pa.int64()).take(pa.array(repeated)),
                        real(of.whitened(x).reshape(-1)),
                        real(np.tile(of.explained, len(x))),
                        pa.array(np.full(len(repeated), errors[x.shape[1]])),
                    ],
                    names,
                )

    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    return held.mapInArrow(applied, schema)
