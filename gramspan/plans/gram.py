"""Sufficient statistics: n, sums and the Gram matrix, in one scan.

Every linear model, PCA, SVD and LDA is a function of these. Few columns use
one native aggregate (partial sums per task, one row to the driver); many
columns use one numpy product per Arrow batch, summed per partition before
anything is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramspan.sources.dataset import Features

# Columns (label included) up to which the native aggregate is used.
EXPRESSION_LIMIT = 6
# A column whose mean exceeds this many standard deviations is summed again
# around its mean, so cancellation costs at most about four digits.
_SHIFT_RATIO = 100.0


@dataclass(frozen=True)
class Moments:
    """``n``, sum of ``z - shift`` and sum of its outer product."""

    n: int
    shift: np.ndarray
    sums: np.ndarray
    cross: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return self.shift + self.sums / self.n

    @property
    def variance(self) -> np.ndarray:
        """Population variance per column."""
        return np.maximum(np.diag(self.centered()), 0.0) / self.n

    @property
    def std(self) -> np.ndarray:
        return np.sqrt(self.variance)

    def centered(self) -> np.ndarray:
        return self.cross - np.outer(self.sums, self.sums) / self.n

    def raw_sums(self) -> np.ndarray:
        return self.sums + self.n * self.shift

    def raw(self) -> np.ndarray:
        a = np.outer(self.sums, self.shift)
        return self.cross + a + a.T + self.n * np.outer(self.shift, self.shift)

    def scaled(self, mean: np.ndarray, std: np.ndarray) -> Moments:
        """Moments of ``(z - mean) / std`` without another scan."""
        return Moments(
            self.n, (self.shift - mean) / std, self.sums / std, self.cross / np.outer(std, std)
        )

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.shift, self.sums + other.sums, self.cross + other.cross)


def moments(df: DataFrame, features: Features, label: str | None = None) -> Moments:
    """Moments of the features, with the label as the last column if given."""
    return _stable(df, features, label, None)[None]


def grouped_moments(df: DataFrame, features: Features, group: str) -> dict[float, Moments]:
    """Moments of the features per value of the numeric column ``group``."""
    return dict(sorted(_stable(df, features, None, group).items()))


def total(parts: dict) -> Moments:
    out = None
    for m in parts.values():
        out = m if out is None else out + m
    return out


def _stable(df, features, label, group):
    p = features.width + (label is not None)
    parts = _scan(df, features, label, group, np.zeros(p))
    whole = total(parts)
    spread, mean = whole.std, whole.mean
    far = np.isfinite(mean) & (np.abs(mean) > _SHIFT_RATIO * spread) & (mean != 0.0)
    if far.any():
        # Group the second scan around the overall mean of the far columns.
        parts = _scan(df, features, label, group, np.where(far, mean, 0.0))
    return parts


def _scan(df, features, label, group, shift):
    features.check(df)
    p = len(shift)
    if not features.is_array and p <= EXPRESSION_LIMIT:
        return _expression_scan(df, features, label, group, shift)
    return _arrow_scan(df, features, label, group, shift)


def _check(n, complete):
    if n == 0:
        raise ValueError("input must have at least one sample")
    if complete != n:
        raise ValueError("null in a feature or label column")


def _expression_scan(df, features, label, group, shift):
    p = len(shift)
    cols = features.columns() + ([F.col(label).cast("double")] if label else [])
    picked = df.select(
        *[c.alias(f"z{j}") for j, c in enumerate(cols)],
        *([F.col(group).cast("double").alias("g")] if group else []),
    )
    z = [F.col(f"z{j}") - F.lit(float(s)) if s else F.col(f"z{j}") for j, s in enumerate(shift)]
    full = F.lit(True)
    for c in picked.columns:
        full = full & F.col(c).isNotNull()
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(full).alias("full")]
    aggs += [F.sum(z[i]).alias(f"s{i}") for i in range(p)]
    aggs += [F.sum(z[i] * z[j]).alias(f"c{i}_{j}") for i in range(p) for j in range(i, p)]
    rows = (picked.groupBy("g").agg(*aggs) if group else picked.agg(*aggs)).collect()
    _check(sum(r["n"] for r in rows), sum(r["full"] for r in rows))
    out = {}
    for r in rows:
        cross = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                cross[i, j] = cross[j, i] = r[f"c{i}_{j}"]
        sums = np.array([r[f"s{i}"] for i in range(p)], dtype=float)
        out[r["g"] if group else None] = Moments(r["n"], shift, sums, cross)
    return out


def arrow_matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """An ``array<double>`` Arrow column as ``(n, width)`` floats, and which
    rows are complete. Incomplete rows are NaN in the matrix."""
    keep = column.is_valid().to_numpy(zero_copy_only=False)
    flat = column.drop_null().flatten()
    block = flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
    if flat.null_count:
        inner = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, width).all(axis=1)
        ok = keep.copy()
        ok[keep] = inner
    else:
        ok = keep
    if keep.all():
        return block, ok.copy()
    out = np.full((len(column), width), np.nan)
    out[keep] = block
    return out, ok.copy()


def _partial_rows(key, index, rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "g": pa.array(np.full(len(rows), key, dtype=float)),
            "i": pa.array(np.asarray(index, dtype=np.int32)),
            "v": pa.array(rows, type=pa.list_(pa.float64())),
        }
    )


def _arrow_scan(df, features, label, group, shift):
    d, p = features.width, len(shift)
    flat = df.select(
        F.col(group).cast("double").alias("g") if group else F.lit(0.0).alias("g"),
        F.col(label).cast("double").alias("y") if label else F.lit(0.0).alias("y"),
        features.vector().alias("x"),
    )
    has_label = label is not None

    def partial(batches):
        sums: dict[float, np.ndarray] = {}
        nulls = 0
        for batch in batches:
            x, keep = arrow_matrix(batch.column("x"), d)
            g = batch.column("g").to_numpy(zero_copy_only=False).astype(float)
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
            keep &= batch.column("g").is_valid().to_numpy(zero_copy_only=False)
            keep &= batch.column("y").is_valid().to_numpy(zero_copy_only=False)
            nulls += int((~keep).sum())
            if not keep.all():
                x, g, y = x[keep], g[keep], y[keep]
            if has_label:
                x = np.column_stack([x, y])
            # A leading column of ones turns counts and sums into Gram entries.
            z = np.column_stack([np.ones(len(x)), x - shift])
            for key in np.unique(g):
                rows = z if (g == key).all() else z[g == key]
                part = rows.T @ rows
                sums[key] = part if key not in sums else sums[key] + part
        # Row -1 carries the number of incomplete rows.
        yield _partial_rows(0.0, [-1], [[float(nulls)]])
        for key, m in sums.items():
            yield _partial_rows(key, np.arange(p + 1), list(m))

    parts = flat.mapInArrow(partial, "g double, i int, v array<double>")
    merged = parts.groupBy("g", "i").agg(
        F.array(*[F.sum(F.get("v", j)) for j in range(p + 1)]).alias("v")
    )
    grams: dict = {}
    for r in merged.collect():
        if r["i"] < 0:
            if r["v"][0]:
                raise ValueError("null in a feature or label column")
            continue
        grams.setdefault(r["g"] if group else None, np.zeros((p + 1, p + 1)))[r["i"]] = r["v"]
    if not grams:
        raise ValueError("input must have at least one sample")
    return {
        k: Moments(int(round(m[0, 0])), shift, m[0, 1:].copy(), m[1:, 1:].copy())
        for k, m in grams.items()
    }
