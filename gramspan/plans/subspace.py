"""Leading eigenpairs of a scatter matrix that is never formed.

A block of directions is multiplied with the scatter of the rows in one pass: every
task multiplies its rows with the block and back, and the products are summed by
tiles of columns. The block Krylov space of a few such passes holds the leading
eigenvectors to full accuracy long before the space is as large as the matrix; the driver
holds its basis, a few hundred vectors at most, and stops by the residual.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramspan.plans.gram import arrow_matrix

# Columns whose sums are shuffled together.
TILE = 512
# Directions beyond those asked for, blocks of the space before it is started again, and most passes.
SPARE, BLOCKS, PASSES = 10, 10, 60


def summed(rows: DataFrame, d: int, wide: int, fn) -> np.ndarray:
    """Sum over batches of ``fn(x)``, a ``(d, wide)`` matrix of the rows ``x`` of each."""

    def partial(batches) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = fn(arrow_matrix(batch.column(0), d)[0])
                total = part if total is None else total + part
        if total is not None:
            tiles = [total[s : s + TILE].ravel() for s in range(0, d, TILE)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(tiles), dtype=np.int32)), pa.array(tiles, pa.list_(pa.float64()))], ["tile", "v"]
            )

    def merge(batches) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for tile, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                v = v.values.to_numpy()
                held[tile] = held[tile] + v if tile in held else v
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array(list(held.values()), pa.list_(pa.float64()))], ["tile", "v"]
        )

    schema = "tile int, v array<double>"
    parts = rows.mapInArrow(partial, schema).repartition("tile").mapInArrow(merge, schema)
    out = np.zeros((d, wide))
    for r in parts.collect():
        s = r["tile"] * TILE
        out[s : s + TILE] = np.reshape(r["v"], (-1, wide))
    return out


def _fresh(block: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """An orthonormal basis of what ``block`` has beyond ``basis``; fewer columns, or none, if it has little."""
    size = np.linalg.norm(block, axis=0).max(initial=0.0)
    for _ in range(2):
        for q in basis:
            block = block - q @ (q.T @ block)
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    return u[:, s > 1e-10 * max(size, 1e-300)]


def leading_eigenpairs(
    rows: DataFrame, d: int, mean: np.ndarray, k: int, tolerance: float = 1e-9, seed: int = 7
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues, falling, and eigenvectors (rows) of the scatter around ``mean``.

    ``rows`` has one ``array<double>`` column without nulls. Each pass is one scan.
    """
    block, kept = min(k + SPARE, d), np.zeros((d, 0))
    start = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, block)))[0]
    basis, images = [], []
    vectors, values = start[:, :k], np.zeros(k)
    for _ in range(PASSES):
        new = _fresh(start, basis)
        if new.shape[1]:
            product = summed(rows, d, new.shape[1], lambda x, v=new: _times(x - mean, v))
            basis.append(new)
            images.append(product)
        q, image = np.column_stack(basis), np.column_stack(images)
        small = q.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-theta)[:block]
        values, vectors, kept = theta[order][:k], q @ turn[:, order[:k]], image @ turn[:, order]
        error = np.linalg.norm(kept[:, :k] - vectors * values, axis=0).max(initial=0.0)
        if not new.shape[1] or error <= tolerance * max(values.max(initial=0.0), 1e-300) or q.shape[1] >= d:
            break
        if len(basis) >= BLOCKS:
            # Start again from the best directions so far, whose products are known.
            best = q @ turn[:, order]
            basis, images = [best], [kept]
            start = kept - best * theta[order]
        else:
            start = images[-1]
    return np.maximum(values, 0.0), vectors.T


def _times(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    return x.T @ (x @ v)


def count_and_mean(rows: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Rows and their mean, without an expression per column."""
    n = rows.count()
    sums = summed(rows, d, 1, lambda x: x.sum(axis=0)[:, None])[:, 0] if n else np.zeros(d)
    return n, sums / max(n, 1)


def total_scatter(rows: DataFrame, d: int, mean: np.ndarray) -> float:
    """Sum of squared distances from ``mean``."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = arrow_matrix(batch.column(0), d)[0] - mean
            yield pa.RecordBatch.from_arrays([pa.array([float((x * x).sum())])], ["s"])

    return rows.mapInArrow(run, "s double").agg(F.coalesce(F.sum("s"), F.lit(0.0))).head()[0]
