"""Embedding whitening on principal components, exact to double precision.

Entries become whole numbers, so that sums and products of centred entries are
exact in doubles and the covariance does not depend on the order of the tasks.
Its eigenvectors are found in single precision and corrected by the iteration of
Ogita and Aishima, matrix products in extended precision: each round squares
the error. Eigenvalues too close to be told apart at the precision reached form
a cluster; the covariance restricted to its vectors, shifted by their mean
eigenvalue and scaled, is a problem of its own with gaps of ordinary size.

Three scans of the vectors fit the model (sums, products, products of the
result); the driver holds d x d numbers, so d should be a few thousand at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramspan.llm.common import stored

# An entry c counts as floor(SCALE * c) + SHIFT, within +-LIMIT.
SCALE, SHIFT, LIMIT = 64, 1_000_000, 1 << 61
# Cells of a batch that are worked on at a time.
CELLS = 1 << 20
_LONG = np.longdouble


# --- eigenvectors on the driver -------------------------------------------------


def _clusters(values: np.ndarray, gap) -> list[np.ndarray]:
    """Positions of values, those within ``gap`` of the next greater one together."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def refine(a: np.ndarray, x: np.ndarray, rounds: int = 16, depth: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of ``a`` from approximate eigenvectors ``x``."""
    d = len(a)
    one, tiny = np.eye(d, dtype=_LONG), d * np.finfo(_LONG).eps
    norm = np.sqrt((a * a).sum())
    last = np.inf
    for _ in range(rounds):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        # So far apart that a step is small and the next error its square.
        reach = 50 * (np.sqrt(((s - np.diag(values)) ** 2).sum()) + norm * np.sqrt((r * r).sum()))
        gaps = values[None, :] - values[:, None]
        apart = np.abs(gaps) > reach
        middle = (values[None, :] + values[:, None]) / 2
        # Half the lack of orthogonality, and a rotation between vectors told apart.
        step = r / 2 + np.where(apart, (s + middle * r) / np.where(apart, gaps, 1), 0)
        x = x + x @ step
        turned = False
        for c in _clusters(values, reach):
            block = x[:, c].T @ (a @ x[:, c])
            block = (block + block.T) / 2
            block -= np.trace(block) / len(c) * np.eye(len(c), dtype=_LONG)
            # What is left below the rounding of the products is one eigenvalue.
            off = np.abs(block - np.diag(np.diag(block))).max()
            if depth and off > tiny * norm:
                x[:, c] = x[:, c] @ eigen(block, depth - 1)[1]
                turned = True
        error = np.abs(step).max()
        if not turned and (error <= tiny or 4 * error >= last):
            break
        last = np.inf if turned else error
    for _ in range(2):
        # Close eigenvalues amplify rounding in the rotations: make the vectors orthogonal once more.
        x = x @ (3 * one - x.T @ x) / 2
    return (x * (a @ x)).sum(0), x


def eigen(a: np.ndarray, depth: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix of long doubles.

    Started in single precision. Of a vector and its opposite, the one whose
    entry of largest size is positive.
    """
    size = np.abs(a).max() if a.size else 0
    if not size:
        return np.zeros(len(a), _LONG), np.eye(len(a), dtype=_LONG)
    scaled = a / size
    start = np.linalg.eigh(scaled.astype(np.float32))[1]
    values, x = refine(scaled, start.astype(_LONG), depth=depth)
    order = np.argsort(-values, kind="stable")
    values, x = values[order] * size, x[:, order]
    top = np.abs(x).argmax(0)
    return values, x * np.where(x[top, np.arange(len(a))] < 0, -1, 1)


# --- rows as whole numbers -------------------------------------------------------


def _whole(batch: pa.RecordBatch, column: int, length: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and whole entries of the usable vectors of a batch, by length and in slices."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy().astype(np.int64))
    begin = lists.offsets.to_numpy().astype(np.int64)[:-1] - lists.offsets[0].as_py()
    sizes[lists.is_null().to_numpy(zero_copy_only=False)] = 0
    # A null entry reads as NaN.
    flat = lists.flatten() if not lists.null_count else lists.values.slice(lists.offsets[0].as_py())
    flat = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    for size in np.unique(sizes):
        if size == 0 or (length is not None and size != length):
            continue
        rows = np.flatnonzero(sizes == size)
        step = max(CELLS // int(size), 1)
        for s in range(0, len(rows), step):
            some = rows[s : s + step]
            c = flat[begin[some][:, None] + np.arange(size)]
            good = np.isfinite(c).all(1)
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(SCALE * c[good]), -LIMIT, LIMIT).astype(np.int64) + SHIFT
            yield some[good], x


def _sums(vectors: DataFrame) -> DataFrame:
    """``size, place, n, high, low``: per length and entry, rows and the sum in two halves."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for rows, x in _whole(batch, 0):
                n, high, low = held.setdefault(x.shape[1], [0, 0, 0])
                held[x.shape[1]] = [n + len(rows), high + (x >> 31).sum(0), low + (x & 0x7FFFFFFF).sum(0)]
        for size, (n, high, low) in held.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, size, np.int32)),
                    pa.array(np.arange(size, dtype=np.int32)),
                    pa.array(np.full(size, n, np.int64)),
                    pa.array(np.asarray(high, np.int64)),
                    pa.array(np.asarray(low, np.int64)),
                ],
                ["size", "place", "n", "high", "low"],
            )

    parts = vectors.mapInArrow(read, "size int, place int, n long, high long, low long")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    return parts.groupBy("size", "place").agg(F.sum("n").alias("n"), *wide)


def _products(vectors: DataFrame, size: int, of) -> np.ndarray:
    """Sum over all usable vectors of the products of any two entries of ``of(x)``."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in _whole(batch, 0, size):
                y = of(x)
                total = y.T @ y + (0 if total is None else total)
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"]
            )

    cells = vectors.mapInArrow(read, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    found = cells.toPandas()
    k = int(found["j"].max()) + 1 if len(found) else 0
    out = np.zeros((k, k))
    out[found["i"], found["j"]] = found["v"]
    return np.triu(out) + np.triu(out, 1).T


# --- the model -------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening. ``values`` fall; ``components`` has a unit vector per row."""

    size: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float

    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]

    def transform(self, df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
        """``key``, ``whitened array<double>``, ``deviation decimal(38,0)`` of every usable row.

        ``deviation`` is the exact squared distance from the mean times n * n,
        null from 1e38 on.
        """
        size, n = self.size, self.n
        centre, rest = _centre(self.sums, n)
        project = _projection(self.components, self.values, centre, rest, n)

        def read(batches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, x in _whole(batch, 1, size):
                    w = project(x)
                    flat = pa.array(w.ravel())
                    ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * w.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(rows)),
                            pa.ListArray.from_arrays(ends, flat),
                            _deviations(x - centre, rest, n),
                        ],
                        [key, "whitened", "deviation"],
                    )

        known = df.select(key, F.col(vector).cast("array<double>").alias("_v"))
        kind = known.schema[0].dataType.simpleString()
        return known.mapInArrow(read, f"`{key}` {kind}, whitened array<double>, deviation decimal(38,0)")


def _centre(sums: tuple[int, ...], n: int) -> tuple[np.ndarray, list[int]]:
    """The mean to the nearest whole number, and what the sums have beyond n times that."""
    centre = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(centre, np.int64), [s - n * c for s, c in zip(sums, centre, strict=True)]


def _projection(components, values, centre, rest, n):
    mean = np.array([float(Decimal(r) / n) for r in rest])
    turn = (components / np.sqrt(values)[:, None]).T
    return lambda x: ((x - centre).astype(np.float64) - mean) @ turn


def _deviations(z: np.ndarray, rest: list[int], n: int) -> pa.Array:
    """Sum over entries of ``(n * z - rest) ** 2``, exact."""
    most = max((n * abs(int(v)) + abs(r) for v, r in zip(np.abs(z).max(0, initial=0), rest, strict=True)), default=0)
    if most * most * max(len(rest), 1) < 1 << 63:
        y = z * n - np.array(rest, np.int64)
        return pa.array((y * y).sum(1)).cast(pa.decimal128(38, 0))
    y = z.astype(object) * n - np.array(rest, object)
    return pa.array([Decimal(v) if v < 10**38 else None for v in map(int, (y * y).sum(1))], pa.decimal128(38, 0))


def fit(df: DataFrame, vector: str = "embedding", most: int = 32) -> Whitening | None:
    """Fit on all rows whose vector is usable; up to ``most`` components.

    A vector is not usable if it is null, empty, or holds null or non-finite
    entries. Vectors must have one length; if they don't, those of the most
    frequent length count (of the longest such) and the others are not usable.
    Components without variance beyond rounding are left out, so fewer rows than
    entries, or constant entries, give fewer components. Without usable rows
    there is no model. Equal rows count each.
    """
    vectors = df.select(F.col(vector).cast("array<double>").alias("_v")).filter("_v is not null")
    sums = stored(_sums(vectors), "whitening-sums")
    chosen = sums.filter("place = 0").orderBy(F.desc("n"), F.desc("size")).select("size", "n").head()
    if chosen is None:
        return None
    size, n = chosen
    rows = sums.filter(F.col("size") == size).orderBy("place").collect()
    total = tuple(int(r["high"]) * (1 << 31) + int(r["low"]) for r in rows)
    centre, rest = _centre(total, n)
    gram = _products(vectors, size, lambda x: (x - centre).astype(np.float64)).astype(_LONG)
    mean = np.array(rest, dtype=object)
    covariance = gram / n - (np.outer(mean, mean).astype(_LONG) / n) / n
    values, x = eigen(covariance)
    kept = min(most, size)
    kept = int((values[:kept] > size * np.finfo(np.float64).eps * max(values[0], 0)).sum())
    values, components = values[:kept].astype(np.float64), x[:, :kept].T.astype(np.float64)
    error = 0.0
    if kept:
        project = _projection(components, values, centre, rest, n)
        products = _products(vectors, size, lambda x: np.column_stack([project(x), np.ones(len(x))]))
        m = products[-1, :-1] / n
        error = float(np.abs(products[:-1, :-1] / n - np.outer(m, m) - np.eye(kept)).max())
    return Whitening(size, n, total, values, components, float(np.trace(covariance)), error)


def whitened_components(df: DataFrame, most: int = 32) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    A row per usable row of ``df`` (``vec_id, embedding``) and component, from 1.
    ``deviation`` is null where it does not fit into a long. Rows that share a
    vec_id, or have none, are each returned. An empty table, or one without two
    different vectors, gives an empty result. Extra columns are ignored.
    """
    model = fit(df, most=most)
    if model is None or not len(model.values):
        shape = "vec_id long, component int, n long, deviation long, whitened double, explained double"
        return df.sparkSession.createDataFrame([], shape + ", identity_error double")
    rows = model.transform(df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"))
    explained = F.array(*map(F.lit, model.explained()))
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("_p", "whitened")).select(
        "vec_id",
        (F.col("_p") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS long)").alias("deviation"),
        "whitened",
        F.element_at(explained, F.col("_p") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
