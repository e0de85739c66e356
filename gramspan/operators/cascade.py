"""Dual problems of support vector machines, solved by a cascade of tasks.

Every task solves the problem of its own rows, a bounded number at a time, and keeps
the support rows alone. Their sets merge up a tree: a node starts from the weights of its
children, whose union is feasible, and solves again. The root's set is then checked
against all rows; those that violate optimality most are merged into it and the
root is solved once more, until no row violates it by more than the tolerance.
Rows never pass the driver; a node holds the support rows below it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramspan.plans.gram import arrow_matrix
from gramspan.session import RollingTable, durable

# Children of a node of the tree.
FAN = 4
# Columns of a kernel block that is held at a time.
_BLOCK = 2048
_ALPHA_MIN = 1e-8

_ROWS = "node long, id long, x array<double>, y double, cap double, u double"


@dataclass(frozen=True)
class Kernel:
    name: str = "rbf"
    gamma: float = 1.0
    degree: int = 3
    coef0: float = 0.0

    def block(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Kernel values of all rows of ``a`` against all rows of ``b``."""
        if self.name == "rbf":
            sq = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
            return np.exp(-self.gamma * np.maximum(sq, 0.0))
        dot = a @ b.T
        if self.name == "linear":
            return dot
        if self.name == "polynomial":
            return (self.gamma * dot + self.coef0) ** self.degree
        return np.tanh(self.gamma * dot + self.coef0)


def solve_dual(kernel, y, cap, u, v, tolerance, budget):
    """Pairwise ascent on the dual of one working set.

    ``u`` is the signed weight, bounded by 0 and ``y * cap``; ``v`` is the label
    minus the score without intercept. The sum of ``u`` is kept. Each step moves
    the most violating row against the partner with the largest gain.
    """
    u, v = u.astype(float).copy(), v.astype(float).copy()
    low, high = np.minimum(0.0, y * cap), np.maximum(0.0, y * cap)
    slack = cap * 1e-12
    diag = np.diag(kernel)
    steps = 0
    for steps in range(1, budget + 1):
        grow, shrink = u < high - slack, u > low + slack
        if not grow.any() or not shrink.any():
            break
        i = int(np.argmax(np.where(grow, v, -np.inf)))
        gap = v[i] - v
        ok = shrink & (gap > 0)
        if not ok.any() or gap[shrink].max() <= tolerance:
            break
        curve = np.maximum(diag[i] + diag - 2.0 * kernel[i], 1e-12)
        j = int(np.argmax(np.where(ok, gap * gap / curve, -np.inf)))
        move = min(gap[j] / curve[j], high[i] - u[i], u[j] - low[j])
        u[i] += move
        u[j] -= move
        v -= move * (kernel[i] - kernel[j])
    return u, v, steps


def extremes(u, v, y, cap) -> tuple[float, float]:
    """The greatest ``v`` of a weight that may grow and the least of one that may shrink."""
    slack = cap * 1e-12
    grow = u < np.maximum(0.0, y * cap) - slack
    shrink = u > np.minimum(0.0, y * cap) + slack
    return float(v[grow].max(initial=-np.inf)), float(v[shrink].min(initial=np.inf))


def minus_scores(kernel: Kernel, x, v, vectors, dual) -> np.ndarray:
    """``v`` less the scores of the rows without intercept."""
    v = v.astype(float).copy()
    for s in range(0, len(vectors), _BLOCK):
        v -= kernel.block(x, vectors[s : s + _BLOCK]) @ dual[s : s + _BLOCK]
    return v


def solve_rows(kernel: Kernel, x, y, cap, u, tolerance: float, budget: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ``v`` at the optimum of these rows, by working sets of ``size``.

    Starts from the feasible weights ``u`` and holds at most ``2 * size`` kernel columns.
    """
    u, half = u.astype(float).copy(), max(size // 2, 1)
    moved = np.flatnonzero(u)
    v = minus_scores(kernel, x, y, x[moved], u[moved])
    low, high, slack = np.minimum(0.0, y * cap), np.maximum(0.0, y * cap), cap * 1e-12
    last = np.zeros(0, np.int64)
    for _ in range(budget):
        up, down = np.flatnonzero(u < high - slack), np.flatnonzero(u > low + slack)
        if not len(up) or not len(down) or v[up].max() - v[down].min() <= tolerance:
            break
        fresh = np.concatenate([up[np.argsort(-v[up])[:half]], down[np.argsort(v[down])[:half]]])
        # The rows of the last round stay in, which keeps rounds from undoing each other.
        chosen = np.union1d(fresh, last)
        block = kernel.block(x[chosen], x[chosen])
        steps = budget * len(chosen)
        new, _, _ = solve_dual(block, y[chosen], cap[chosen], u[chosen], v[chosen], tolerance / 2, steps)
        change = new - u[chosen]
        moved = np.flatnonzero(change)
        if not len(moved):
            break
        u[chosen] = new
        v = minus_scores(kernel, x, v, x[chosen[moved]], change[moved])
        last = np.unique(fresh)
    return u, v


@dataclass(frozen=True)
class Cascade:
    """How the nodes solve: kernel, tolerance, most rounds, and rows of a leaf."""

    kernel: Kernel
    tolerance: float
    budget: int
    leaf: int

    def _solve(self, ids, x, y, cap, u):
        u, v = solve_rows(self.kernel, x, y, cap, u, self.tolerance / 2, self.budget, self.leaf)
        keep = np.abs(u) > _ALPHA_MIN
        return (ids[keep], x[keep], y[keep], cap[keep], u[keep]), extremes(u, v, y, cap)

    def _solved(self, node: int, found, ends: tuple[float, float]) -> pa.RecordBatch:
        """The support rows of a node, and a row without id for its extremes."""
        ids, x, y, cap, u = found
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(ids) + 1, node, np.int64)),
                pa.array([*ids.tolist(), None], pa.int64()),
                pa.array([*x.tolist(), None], pa.list_(pa.float64())),
                pa.array(np.append(y, ends[0])),
                pa.array(np.append(cap, ends[1])),
                pa.array(np.append(u, 0.0)),
            ],
            ["node", "id", "x", "y", "cap", "u"],
        )

    def leaves(self, state: DataFrame, width: int) -> DataFrame:
        """A node per partition: rows join the support rows found so far, ``leaf`` at a time."""

        def read(batches) -> Iterator[pa.RecordBatch]:
            none = np.zeros(0)
            held = (none.astype(np.int64), none.reshape(0, width), none, none, none)
            ends, waiting = (-np.inf, np.inf), 0
            for batch in batches:
                rows = _rows(batch, width)
                for s in range(0, len(rows[0]), self.leaf):
                    part = [c[s : s + self.leaf] for c in rows]
                    held = tuple(np.concatenate(c) for c in zip(held, part, strict=True))
                    waiting += len(part[0])
                    if waiting >= self.leaf:
                        held, ends = self._solve(*held)
                        waiting = 0
            if waiting:
                held, ends = self._solve(*held)
            yield self._solved(TaskContext.get().partitionId(), held, ends)

        return state.select("id", "x", "y", "cap", F.lit(0.0).alias("u")).mapInArrow(read, _ROWS)

    def merged(self, rows: DataFrame, nodes: int, width: int) -> DataFrame:
        """One problem for each node; the weights of its children are its start."""

        def read(batches) -> Iterator[pa.RecordBatch]:
            now, parts = None, []

            def solved():
                joined = tuple(np.concatenate(c) for c in zip(*parts, strict=True))
                yield self._solved(now, *self._solve(*joined))

            for batch in batches:
                batch = batch.filter(batch.column(1).is_valid())
                node = batch.column(0).to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(node)) + 1).tolist(), len(node)]
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    if a == b:
                        continue
                    if node[a] != now:
                        if parts:
                            yield from solved()
                        now, parts = int(node[a]), []
                    parts.append(_rows(batch.slice(a, b - a), width))
            if parts:
                yield from solved()

        return rows.repartition(nodes, "node").sortWithinPartitions("node", "id").mapInArrow(read, _ROWS)

    def root(self, state: DataFrame, leaves: int, width: int) -> DataFrame:
        """The support rows of the whole tree over the partitions of ``state``, as a durable table."""
        rows, nodes = self.leaves(state, width), leaves
        while nodes > 1:
            nodes = -(-nodes // FAN)
            rows = self.merged(rows.withColumn("node", F.floor(F.col("node") / FAN)), nodes, width)
        return durable(rows)

    def again(self, support: DataFrame, worst: DataFrame, width: int) -> DataFrame:
        """The root's problem with the worst rows merged in."""
        names = ["id", "x", "y", "cap", "u"]
        rows = support.filter("id is not null").select(*names).unionByName(worst.select(*names))
        return durable(self.merged(rows.select(F.lit(0).cast("long").alias("node"), *names), 1, width))


def _rows(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    by = dict(zip(batch.schema.names, batch.columns, strict=True))
    return (by["id"].to_numpy(), arrow_matrix(by["x"], width)[0], *(by[c].to_numpy() for c in ("y", "cap", "u")))


def against_all(
    table: RollingTable, state: DataFrame, support: DataFrame, kernel: Kernel, width: int, chunk: int
) -> DataFrame:
    """``state`` with the weight ``u`` and ``v`` = y - score of every row.

    The support rows go out ``chunk`` at a time, in one map over the rows each.
    """
    known = support.filter("id is not null")
    parts = max(-(-known.count() // chunk), 1)
    out = state.select("id", "x", "y", "cap", F.lit(0.0).alias("u"), F.col("y").alias("v"))
    for part in range(parts):
        some = known.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).select("id", "x", "u").orderBy("id").collect()
        vectors = np.array([r["x"] for r in some], dtype=float).reshape(len(some), width)
        ids, dual = np.array([r["id"] for r in some], np.int64), np.array([r["u"] for r in some])
        out = table.advance(_with_change(out, kernel, width, ids, vectors, dual))
    return out


def _with_change(rows: DataFrame, kernel: Kernel, width: int, ids, vectors, dual) -> DataFrame:
    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, _ = arrow_matrix(batch.column("x"), width)
            keys, u = batch.column("id").to_numpy(), batch.column("u").to_numpy().copy()
            if len(ids):
                spot = np.minimum(np.searchsorted(ids, keys), len(ids) - 1)
                hit = ids[spot] == keys
                u[hit] = dual[spot[hit]]
            cols = {name: batch.column(name) for name in batch.schema.names}
            cols["u"] = pa.array(u)
            cols["v"] = pa.array(minus_scores(kernel, x, batch.column("v").to_numpy(), vectors, dual))
            yield pa.RecordBatch.from_pydict(cols)

    return rows.mapInArrow(read, "id long, x array<double>, y double, cap double, u double, v double")


def violations(scored: DataFrame) -> tuple[DataFrame, float, float]:
    """``scored`` with ``up`` and ``down`` (may the weight grow, shrink), and the extremes of ``v``."""
    slack = F.col("cap") * 1e-12
    high = F.when(F.col("y") > 0, F.col("cap")).otherwise(F.lit(0.0))
    low = F.when(F.col("y") > 0, F.lit(0.0)).otherwise(-F.col("cap"))
    rows = scored.withColumns({"up": F.col("u") < high - slack, "down": F.col("u") > low + slack})
    top, bottom = F.max(F.when(F.col("up"), F.col("v"))), F.min(F.when(F.col("down"), F.col("v")))
    return rows, *rows.agg(top, bottom).head()


def worst_rows(rows: DataFrame, bias: float, tolerance: float, most: int) -> DataFrame:
    """Of the rows without weight that violate optimality, about the ``most`` worst; a histogram finds the bound."""
    excess = F.greatest(
        F.when(F.col("up"), F.col("v") - F.lit(bias)).otherwise(F.lit(0.0)),
        F.when(F.col("down"), F.lit(bias) - F.col("v")).otherwise(F.lit(0.0)),
    )
    bad = rows.filter(F.abs("u") <= _ALPHA_MIN).withColumn("excess", excess).filter(F.col("excess") > tolerance / 4)
    step = F.floor(F.log2("excess") * 8)
    bins = bad.groupBy(step.alias("bin")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("bin")).collect()
    least, seen = None, 0
    for r in bins:
        if least is not None and seen + r["n"] > most:
            break
        least, seen = r["bin"], seen + r["n"]
    return bad if least is None else bad.filter(step >= least)
