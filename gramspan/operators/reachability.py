"""Density clusters at many settings from one forest.

The core distance of a point is the least radius that holds ``min_samples`` rows;
the reachability of two points is the greatest of their distance and both core
distances. At a radius ``eps`` the core points are those with a core distance up to ``eps``,
and their clusters are what edges of reachability up to ``eps`` connect. A minimum
spanning forest keeps these connections at every radius: clusters are
core points less forest edges. So distances are computed up to the largest radius
once; blocks of points give their nearest neighbours, then their own forests, and the
forests are merged by tasks that each drop the heaviest edge of every cycle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramspan.plans.components import connected_components
from gramspan.plans.gram import arrow_matrix
from gramspan.plans.neighbours import Blocks, pairwise_within
from gramspan.session import durable

# Edges that a task reduces to a forest at a time.
TASK_EDGES = 500_000
_STEP = 100_000


def close_pairs(a: np.ndarray, b: np.ndarray, eps: float, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of ``a`` and ``b`` within ``eps``, and their distances."""
    i, j = np.nonzero(pairwise_within(a, b, eps, metric))
    out = np.empty(len(i))
    for s in range(0, len(i), _STEP):
        diff = np.abs(a[i[s : s + _STEP]] - b[j[s : s + _STEP]])
        out[s : s + _STEP] = diff.sum(axis=1) if metric == "manhattan" else np.sqrt((diff * diff).sum(axis=1))
    return i, j, out


def spanning_forest(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Positions of the edges of a minimum spanning forest; ties go to the edge that comes first by ends.

    Rounds in which every tree takes its least edge out.
    """
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[: len(a)], flat[len(a) :]
    # One order for all edges, whatever subset they are seen in.
    order = np.lexsort((np.maximum(a, b), np.minimum(a, b), weight))
    rank = np.empty(len(a), np.int64)
    rank[order] = np.arange(len(a))
    tree, taken = np.arange(len(nodes)), np.zeros(len(a), bool)
    open_ = np.flatnonzero(left != right)
    while len(open_):
        best = np.full(len(nodes), len(a))
        for side in (left, right):
            np.minimum.at(best, tree[side[open_]], rank[open_])
        chosen = order[np.unique(best[best < len(a)])]
        taken[chosen] = True
        # Merge the trees along the edges taken: hook the greater root, then flatten.
        while True:
            x, y = tree[left[chosen]], tree[right[chosen]]
            low = np.minimum(x, y)
            new = tree.copy()
            np.minimum.at(new, x, low)
            np.minimum.at(new, y, low)
            while (new[new] != new).any():
                new = new[new]
            if (new == tree).all():
                break
            tree = new[tree]
        open_ = open_[tree[left[open_]] != tree[right[open_]]]
    return np.flatnonzero(taken)


def _core_distances(blocks: Blocks, points: DataFrame, d: int, eps: float, metric: str, samples: Sequence[int]) -> DataFrame:
    """``points`` with ``core``: per entry of ``samples`` the core distance, infinite beyond ``eps``."""
    most = max(samples)

    def nearest(left, right):
        a = arrow_matrix(left.column("x").combine_chunks(), d)[0]
        b = a if right is None else arrow_matrix(right.column("x").combine_chunks(), d)[0]
        other = left if right is None else right
        i, j, gap = close_pairs(a, b, eps, metric)
        ids, gaps, rows = [], [], []
        sides = [(left, other, i, j)] if right is None else [(left, other, i, j), (other, left, j, i)]
        for mine, theirs, p, q in sides:
            w = theirs.column("w").to_numpy()[q]
            order = np.lexsort((gap, p))
            first = np.searchsorted(p[order], p[order])
            before = np.cumsum(w[order]) - w[order]
            keep = order[before - before[first] < most] if len(order) else order
            ids.append(mine.column("id").to_numpy()[p[keep]])
            gaps.append(gap[keep])
            rows.append(w[keep])
        return pa.table({"id": np.concatenate(ids), "gap": np.concatenate(gaps), "rows": np.concatenate(rows)})

    near = blocks.compare(points, ["id", "w", "x"], nearest, "id long, gap double, rows long")
    lists = near.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("gap", "rows"))).alias("near"))
    none = F.lit(float("inf"))

    def reach(m):
        start = F.struct(F.lit(0).cast("long").alias("rows"), none.alias("core"))
        step = lambda acc, v: F.struct(
            (acc["rows"] + v["rows"]).alias("rows"),
            F.when((acc["rows"] < m) & (acc["rows"] + v["rows"] >= m), v["gap"]).otherwise(acc["core"]).alias("core"),
        )
        return F.aggregate("near", start, step, lambda acc: acc["core"])

    return points.join(lists.select("id", F.array(*map(reach, samples)).alias("core")), "id")


def _local_forests(blocks: Blocks, cored: DataFrame, d: int, eps: float, metric: str, count: int) -> DataFrame:
    """``m, a, b, w``: forests of block pairs; with ``b`` null, that ``a`` is within ``w`` of a core point."""

    def forest(left, right):
        a = arrow_matrix(left.column("x").combine_chunks(), d)[0]
        b = a if right is None else arrow_matrix(right.column("x").combine_chunks(), d)[0]
        other = left if right is None else right
        i, j, gap = close_pairs(a, b, eps, metric)
        ids, theirs = left.column("id").to_numpy(), other.column("id").to_numpy()
        mine_core = arrow_matrix(left.column("core").combine_chunks(), count)[0]
        their_core = arrow_matrix(other.column("core").combine_chunks(), count)[0]
        out = []
        for m in range(count):
            p, q = mine_core[i, m], their_core[j, m]
            w = np.maximum(gap, np.maximum(p, q))
            use = np.flatnonzero((w <= eps) & ((i < j) if right is None else True))
            use = use[spanning_forest(ids[i[use]], theirs[j[use]], w[use])]
            out.append((m, ids[i[use]], theirs[j[use]], w[use]))
            for side, n, reach in ((ids, i, np.maximum(gap, q)), (theirs, j, np.maximum(gap, p))):
                best = np.full(len(side), np.inf)
                np.minimum.at(best, n, reach)
                some = np.flatnonzero(best <= eps)
                out.append((m, side[some], None, best[some]))
        return pa.table(
            {
                "m": np.concatenate([np.full(len(x), m, np.int32) for m, x, _, _ in out]),
                "a": np.concatenate([x for _, x, _, _ in out]),
                "b": pa.concat_arrays([pa.nulls(len(x), pa.int64()) if y is None else pa.array(y) for _, x, y, _ in out]),
                "w": np.concatenate([w for *_, w in out]),
            }
        )

    return blocks.compare(cored, ["id", "x", "core"], forest, "m int, a long, b long, w double")


def _reduced(batches) -> Iterator[pa.RecordBatch]:
    """The forests of a task's edges, a bounded number at a time; a heavier edge of a cycle is in no forest."""

    def forests(parts):
        m, a, b, w = (np.concatenate(c) for c in zip(*parts, strict=True))
        keep = []
        for k in np.unique(m):
            at = np.flatnonzero(m == k)
            keep.append(at[spanning_forest(a[at], b[at], w[at])])
        keep = np.concatenate(keep)
        return m[keep], a[keep], b[keep], w[keep]

    def out(part):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in part], ["m", "a", "b", "w"])

    parts, held = [], 0
    for batch in batches:
        parts.append(tuple(c.to_numpy() for c in batch.columns))
        held += batch.num_rows
        if held > 2 * TASK_EDGES:
            parts = [forests(parts)]
            held = len(parts[0][0])
            if held > TASK_EDGES:
                yield out(parts[0])
                parts, held = [], 0
    if held:
        yield out(forests(parts))


def merged_forest(edges: DataFrame) -> tuple[DataFrame, bool]:
    """``edges`` without those that tasks find to close a cycle, and whether that is the whole forest.

    Each round deals the edges out to as many tasks as they fill, until one
    task holds them all or a round no longer drops a tenth.
    """
    edges = durable(edges)
    n = edges.count()
    while True:
        tasks = max(-(-n // TASK_EDGES), 1)
        edges = durable(edges.repartition(tasks).mapInArrow(_reduced, "m int, a long, b long, w double"))
        if tasks == 1:
            return edges, True
        left = edges.count()
        if left > 0.9 * n and left > TASK_EDGES:
            return edges, False
        n = left


def count_clusters(points: DataFrame, d: int, settings: Sequence[tuple[float, int]], metric: str) -> list[tuple[int, int, int]]:
    """``n_clusters, n_noise, n_core`` per setting, of distinct finite points ``id, x, w`` (rows of each)."""
    eps, samples = max(e for e, _ in settings), sorted({m for _, m in settings})
    blocks = Blocks(points, d, eps)
    cored = durable(_core_distances(blocks, durable(blocks.points), d, eps, metric, samples))
    found = durable(_local_forests(blocks, cored, d, eps, metric, len(samples)))
    forest, whole = merged_forest(found.filter("b is not null"))
    border = found.filter("b is null").groupBy("a").pivot("m", list(range(len(samples)))).agg(F.min("w"))
    near = cored.select("id", "w", "core").join(border.withColumnRenamed("a", "id"), "id", "left")
    totals = []
    for t, (e, m) in enumerate(settings):
        k = samples.index(m)
        core = F.get("core", k) <= e
        reached = core | F.coalesce(F.col(str(k)) <= e, F.lit(False))
        totals += [
            F.count_if(core).alias(f"points{t}"),
            F.coalesce(F.sum(F.when(core, F.col("w"))), F.lit(0)).alias(f"core{t}"),
            F.coalesce(F.sum(F.when(~reached, F.col("w"))), F.lit(0)).alias(f"noise{t}"),
        ]
    row = near.agg(*totals).head()
    if whole:
        held = [F.count_if((F.col("m") == samples.index(m)) & (F.col("w") <= e)) for e, m in settings]
        joined = forest.agg(*held).head()
    else:
        joined = [_joined(forest.filter((F.col("m") == samples.index(m)) & (F.col("w") <= e))) for e, m in settings]
    return [(row[f"points{t}"] - joined[t], row[f"noise{t}"], row[f"core{t}"]) for t in range(len(settings))]


def _joined(edges: DataFrame) -> int:
    """Edges of a spanning forest of ``edges``."""
    r = connected_components(edges.select("a", "b")).agg(F.count(F.lit(1)), F.count_if(F.col("node") == F.col("label"))).head()
    return r[0] - r[1]
