"""Density-based clustering, exact, as joins and connected components.

A point is core when at least ``min_samples`` rows (itself included) lie
within ``eps``. Core points within ``eps`` of each other share a cluster;
clusters are numbered by their first core row, a border point joins the
lowest-numbered cluster with a core point in reach, everything else is -1.
These rules do not depend on the order in which points are visited.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramspan.functions import euclidean, manhattan
from gramspan.operators.reachability import count_clusters
from gramspan.plans.components import connected_components, least_node
from gramspan.plans.neighbours import (
    DIRECT_PAIRS,
    GRID_WIDTH,
    Blocks,
    Grid,
    box_range,
    pairwise_within,
    point_distance,
)
from gramspan.plans.ordering import with_row_index
from gramspan.plans.skew import hot_keys, skew_join
from gramspan.session import durable
from gramspan.sources import TabularDataset

# Points per label that look for other clusters first.
PROBES = 16


@dataclass(frozen=True)
class DBSCANModel:
    """``labels`` holds the input columns plus ``cluster`` and ``is_core``."""

    labels: DataFrame

    def summary(self) -> DataFrame:
        """One row ``n_clusters, n_noise, n_core``."""
        inside = F.col("cluster") >= 0
        # Clusters are numbered without gaps, so the last number counts them.
        return self.labels.agg(
            F.coalesce(F.max(F.when(inside, F.col("cluster"))) + 1, F.lit(0.0))
            .cast("long")
            .alias("n_clusters"),
            F.count_if(~inside).alias("n_noise"),
            F.count_if("is_core").alias("n_core"),
        )

    def get_n_clusters(self) -> int:
        return self.summary().head()["n_clusters"]

    def get_n_noise_points(self) -> int:
        return self.summary().head()["n_noise"]

    def core_samples(self) -> DataFrame:
        return self.labels.filter("is_core")

    def sizes(self) -> DataFrame:
        """Rows per cluster, noise (-1) included."""
        return self.labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))

    def predict(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError("DBSCAN does not label new data; use fit_predict")


class DBSCAN:
    def __init__(self, eps: float, min_samples: int, metric: str = "euclidean"):
        if not eps > 0:
            raise ValueError(f"eps must be > 0, got {eps}")
        if min_samples < 1:
            raise ValueError(f"min_samples must be > 0, got {min_samples}")
        if metric not in ("euclidean", "manhattan"):
            raise ValueError("metric must be 'euclidean' or 'manhattan'")
        self.eps, self.min_samples, self.metric = float(eps), min_samples, metric

    def fit(self, ds: TabularDataset) -> DBSCANModel:
        return self.fit_indexed(ds, index_rows(ds))

    def fit_predict(self, ds: TabularDataset) -> DataFrame:
        return self.fit(ds).labels

    def fit_indexed(self, ds: TabularDataset, base: DataFrame) -> DBSCANModel:
        """Fit on rows already numbered by ``index_rows``."""
        d = ds.features.width
        seen = base.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("_x").isNull() | F.exists("_x", lambda v: v.isNull())).alias("bad"),
        ).head()
        if seen["n"] == 0:
            raise ValueError("input must have at least one sample")
        if seen["bad"]:
            raise ValueError("null in a feature column")
        # A row with NaN or an infinity is within eps of nothing, itself included.
        finite = F.forall("_x", lambda v: F.abs(v) < float("inf"))
        unique = (
            base.filter(finite)
            .groupBy("_x")
            .agg(F.min("_row").alias("id"), F.count(F.lit(1)).alias("w"))
        )
        # Copies of a point share its fate, so each distinct point is kept once.
        points = durable(unique.withColumnRenamed("_x", "x"))
        n = points.count()
        run = self._grid_labels if d <= GRID_WIDTH else self._block_labels
        found = durable(run(points, d, n))
        weights = points.select(F.col("x").alias("_x"), "id", "w")
        hot = hot_keys(weights, ["_x"], "w", seen["n"])
        by_point = weights.join(found, "id").select("_x", "cluster", "is_core")
        known = skew_join(base.filter(finite), by_point, ["_x"], hot)
        other = base.filter(~finite).withColumns({"cluster": F.lit(-1.0), "is_core": F.lit(False)})
        return DBSCANModel(known.unionByName(other).drop("_x", "_row"))

    # --- low dimension ------------------------------------------------------

    def _grid_labels(self, points: DataFrame, d: int, n: int) -> DataFrame:
        grid = Grid(d, self.eps, self.metric)
        flat = points.select("id", "w", *[F.get("x", j).alias(c) for j, c in enumerate(grid.x)])
        placed = grid.place(flat)
        lo, hi = grid.columns(grid.lo), grid.columns(grid.hi)
        within = box_range(self.metric, lo, hi, lo, hi)[1] <= self.eps
        cells = placed.groupBy(*grid.cell).agg(
            *grid.boxes(), F.sum("w").alias("rows"), F.count(F.lit(1)).alias("size")
        )
        cells = durable(cells.withColumn("within", within))
        if not cells.filter(~F.col("within")).isEmpty():
            # eps is too fine for the coordinates' precision: cells mean nothing.
            return self._block_labels(points, d, n)
        # In a dense cell everything is within eps of everything: all core.
        cells = cells.withColumn("dense", F.col("rows") >= self.min_samples)
        hot = hot_keys(cells, grid.cell, "size", n)
        tagged = durable(
            skew_join(placed, cells.select(*grid.cell, "dense"), grid.cell, hot)
        )
        sparse_core = self._sparse_core(grid, tagged, cells, hot)
        marked = durable(
            tagged.filter("dense")
            .withColumn("is_core", F.lit(True))
            .unionByName(
                tagged.filter(~F.col("dense"))
                .join(sparse_core.withColumn("_core", F.lit(True)), "id", "left")
                .withColumn("is_core", F.coalesce("_core", F.lit(False)))
                .drop("_core")
            )
            .drop("dense")
        )
        core = marked.filter("is_core")
        clusters = self._cell_clusters(grid, core, hot, n)
        core_labels = skew_join(
            core, clusters.select(*grid.cell, "cluster"), grid.cell, hot
        ).select("id", "cluster", F.lit(True).alias("is_core"))
        rest = marked.filter(~F.col("is_core"))
        border = self._border(grid, rest, cells.filter(~F.col("dense")), core, clusters, hot)
        rest_labels = rest.join(border, "id", "left").select(
            "id", F.coalesce("cluster", F.lit(-1.0)).alias("cluster"), F.lit(False).alias("is_core")
        )
        return core_labels.unionByName(rest_labels)

    def _reach(
        self, grid: Grid, queries: DataFrame, cells: DataFrame, targets: DataFrame
    ) -> DataFrame:
        """Each query point with every target cell its radius touches.

        ``cells`` are the cells of the query points, with boxes around them.

        ``far2`` tells whether the whole cell is in reach. Query points come
        from cells with few points, so they may meet each neighbour cell.
        """
        boxes = cells.select(*grid.cell, *grid.lo, *grid.hi)
        pairs = grid.neighbour_pairs(boxes, targets)
        keep = [c for c in pairs.columns if c.startswith("b_")]
        pairs = pairs.select(*["a_" + c for c in grid.cell], *keep)
        pairs = pairs.withColumnsRenamed({"a_" + c: c for c in grid.cell})
        met = queries.join(pairs, grid.cell).drop(*grid.cell)
        x = grid.columns(grid.x)
        near, far = box_range(
            self.metric, x, x, grid.columns(grid.lo, "b_"), grid.columns(grid.hi, "b_")
        )
        return met.filter(near <= self.eps).withColumn("far2", far <= self.eps)

    def _straddling(self, grid: Grid, met: DataFrame, points: DataFrame, hot) -> DataFrame:
        """Settle partly reached cells on their points."""
        q = met.filter(~F.col("far2")).withColumnsRenamed({x: "q_" + x for x in grid.x})
        q = q.withColumnRenamed("id", "q_id").drop("w", "dense", "is_core")
        q = q.withColumnsRenamed({"b_" + c: c for c in grid.cell})
        q = q.drop(*["b_" + c for c in grid.lo + grid.hi])
        pairs = skew_join(points.select("w", *grid.cell, *grid.x), q, grid.cell, hot)
        dist = point_distance(self.metric, grid.columns(grid.x, "q_"), grid.columns(grid.x))
        return pairs.filter(dist <= self.eps)

    def _sparse_core(self, grid: Grid, tagged: DataFrame, cells: DataFrame, hot) -> DataFrame:
        """Ids of core points outside dense cells."""
        targets = cells.select(*grid.cell, *grid.lo, *grid.hi, "rows")
        sparse = ~F.col("dense")
        met = durable(self._reach(grid, tagged.filter(sparse), cells.filter(sparse), targets))
        sums = met.groupBy("id").agg(
            F.sum(F.when(F.col("far2"), F.col("b_rows")).otherwise(0)).alias("sure"),
            F.sum("b_rows").alias("most"),
        )
        sums = sums.filter(F.col("most") >= self.min_samples)
        settled = sums.filter(F.col("sure") >= self.min_samples)
        open_ids = sums.filter(F.col("sure") < self.min_samples).select("id", "sure")
        partial = (
            self._straddling(grid, met.join(open_ids, "id"), tagged, hot)
            .groupBy("q_id", "sure")
            .agg(F.sum("w").alias("more"))
            .filter(F.col("sure") + F.col("more") >= self.min_samples)
        )
        return settled.select("id").unionByName(partial.select(F.col("q_id").alias("id")))

    def _cell_clusters(self, grid: Grid, core: DataFrame, hot, n: int) -> DataFrame:
        """Cells with core points and the number of their cluster."""
        cells = durable(
            core.groupBy(*grid.cell).agg(
                *grid.boxes(), F.min("id").alias("cid"), F.count(F.lit(1)).alias("size")
            )
        )
        pairs = durable(
            grid.neighbour_pairs(cells, cells, half=True).select(
                "a_cid", "b_cid", "a_size", "b_size", "far"
            )
        )
        certain = pairs.filter("far").select("a_cid", "b_cid")
        # Core points of one cell are connected, so only cells need linking.
        first = connected_components(certain)
        left = first.select(F.col("node").alias("a_cid"), F.col("label").alias("la"))
        right = first.select(F.col("node").alias("b_cid"), F.col("label").alias("lb"))
        pending = durable(
            pairs.filter(~F.col("far"))
            .join(left, "a_cid", "left")
            .join(right, "b_cid", "left")
            .filter(F.coalesce("la", "a_cid") != F.coalesce("lb", "b_cid"))
            .select("a_cid", "b_cid", "a_size", "b_size")
        )
        edges = certain
        if not pending.isEmpty():
            edges = edges.unionByName(self._refine(grid, core, cells, pending, hot))
            labels = durable(connected_components(edges))
        else:
            labels = first
        named = cells.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
            "label", F.coalesce("label", "cid")
        )
        numbers = with_row_index(named.select("label").distinct(), ["label"], "cluster")
        per_label = named.groupBy("label").agg(F.count(F.lit(1)).alias("cells"))
        busy = hot_keys(per_label, ["label"], "cells", n)
        numbers = numbers.withColumn("cluster", F.col("cluster").cast("double"))
        return durable(skew_join(named, numbers, ["label"], busy).drop("label"))

    def _refine(self, grid: Grid, core, cells, pending, hot) -> DataFrame:
        """Which pending cell pairs hold core points within ``eps``.

        Small pairs are settled on points. For the others both cells are cut
        into smaller boxes: one pair of boxes within reach settles the cell
        pair, boxes out of reach drop out, and the rest is cut again. A box
        with a single point has no extent, so this ends.
        """
        touched = pending.select(F.col("a_cid").alias("cid")).unionByName(
            pending.select(F.col("b_cid").alias("cid"))
        )
        flags = cells.join(touched.distinct().withColumn("_in", F.lit(True)), "cid", "left")
        points = durable(
            skew_join(core, flags.select(*grid.cell, "cid", "_in"), grid.cell, hot)
            .filter("_in")
            .select("cid", *grid.x)
        )
        cut = 4 if grid.d <= 2 else 2
        sub = [f"s{j}" for j in range(grid.d)]
        parent = [f"p{j}" for j in range(grid.d)]
        level, found = 0, []
        todo = pending.select(
            "a_cid",
            "b_cid",
            *[F.lit(0).cast("long").alias(f"{side}_{s}") for side in "ab" for s in sub],
            "a_size",
            "b_size",
        )
        # Level 0 puts a whole cell into sub-box 0.
        placed = points.withColumns({s: F.lit(0).cast("long") for s in sub})
        key = ["cid", *sub]
        n = points.count()
        crowded = cells.select("cid", *[F.lit(0).cast("long").alias(s) for s in sub], "size")
        while True:
            small = todo.filter(F.col("a_size") * F.col("b_size") <= DIRECT_PAIRS)
            busy = hot_keys(crowded, key, "size", n)
            joined = small
            for tag in "ab":
                side_points = placed.withColumnsRenamed({c: f"{tag}_{c}" for c in placed.columns})
                side_busy = busy and busy.withColumnsRenamed({c: f"{tag}_{c}" for c in key})
                joined = skew_join(side_points, joined, [f"{tag}_{c}" for c in key], side_busy)
            near = point_distance(self.metric, grid.columns(grid.x, "a_"), grid.columns(grid.x, "b_"))
            direct = joined.filter(near <= self.eps).select("a_cid", "b_cid").distinct()
            direct = durable(direct)
            found.append(direct)
            todo = todo.filter(F.col("a_size") * F.col("b_size") > DIRECT_PAIRS)
            todo = durable(todo.join(direct, ["a_cid", "b_cid"], "left_anti"))
            if todo.isEmpty():
                break
            level += 1
            side = grid.side / cut**level
            # Sides shrink by powers of two, so a box lies in exactly one parent.
            placed = points.withColumns(
                {
                    s: F.floor(F.col(x) / F.lit(side)).cast("long")
                    for s, x in zip(sub, grid.x, strict=True)
                }
            )
            if level == 1:
                above = {p: F.lit(0).cast("long") for p in parent}
            else:
                above = {
                    p: F.floor(F.col(s) / F.lit(cut)).cast("long")
                    for p, s in zip(parent, sub, strict=True)
                }
            boxes = durable(
                placed.groupBy("cid", *sub)
                .agg(*grid.boxes(), F.count(F.lit(1)).alias("size"))
                .withColumns(above)
            )
            crowded = boxes
            todo = todo.drop("a_size", "b_size")
            for tag in "ab":
                todo = todo.withColumnsRenamed(
                    {f"{tag}_{s}": f"{tag}_{p}" for s, p in zip(sub, parent, strict=True)}
                )
            for tag in "ab":
                named = boxes.withColumnsRenamed({c: f"{tag}_{c}" for c in boxes.columns})
                todo = todo.join(named, [f"{tag}_cid", *[f"{tag}_{p}" for p in parent]])
            low, high = box_range(
                self.metric,
                grid.columns(grid.lo, "a_"),
                grid.columns(grid.hi, "a_"),
                grid.columns(grid.lo, "b_"),
                grid.columns(grid.hi, "b_"),
            )
            todo = durable(
                todo.filter(low <= self.eps)
                .withColumn("far", high <= self.eps)
                .select(
                    "a_cid",
                    "b_cid",
                    *[f"{tag}_{s}" for tag in "ab" for s in sub],
                    "a_size",
                    "b_size",
                    "far",
                )
            )
            settled = durable(todo.filter("far").select("a_cid", "b_cid").distinct())
            found.append(settled)
            todo = todo.join(settled, ["a_cid", "b_cid"], "left_anti").drop("far")
        return reduce(DataFrame.unionByName, found)

    def _border(self, grid: Grid, rest, cells, core, clusters, hot) -> DataFrame:
        """Lowest cluster within reach of each non-core point that has one."""
        targets = clusters.select(*grid.cell, *grid.lo, *grid.hi, "cluster")
        met = durable(self._reach(grid, rest, cells, targets))
        sure = met.filter("far2").groupBy("id").agg(F.min("b_cluster").alias("sure"))
        # Only a partly reached cell of a lower cluster can change the answer.
        maybe = met.join(sure, "id", "left").filter(
            F.col("sure").isNull() | (F.col("b_cluster") < F.col("sure"))
        )
        touched = self._straddling(grid, maybe, core, hot).select(
            F.col("q_id").alias("id"), F.col("b_cluster").alias("cluster")
        )
        both = touched.unionByName(sure.withColumnRenamed("sure", "cluster"))
        return both.groupBy("id").agg(F.min("cluster").alias("cluster"))

    # --- high dimension -----------------------------------------------------

    def _block_labels(self, points: DataFrame, d: int, n: int) -> DataFrame:
        """Labels from blocks, most of them from a point's own block.

        A point with enough rows in its own block is core whatever else is near, and core points that
        are linked inside a block need no other link. So all blocks are searched only for
        points that are still short of rows, for links of clusters that are not part of the
        largest one yet, and for the clusters that border points touch.
        """
        eps, metric, least = self.eps, self.metric, self.min_samples
        blocks = Blocks(points, d, eps)

        def count(side):
            w, rows = side.values("w"), np.zeros(len(side), np.int64)
            for i, j in side.near(side, eps):
                a, b = side.parts[i], side.parts[j]
                if i > j or min(rows[a].min(), rows[b].min()) >= least:
                    continue
                close = pairwise_within(side.x[a], side.x[b], eps, metric)
                rows[a] += close @ w[b]
                if i < j:
                    rows[b] += w[a] @ close
            return side.table.append_column("rows", pa.array(rows))

        def total(asks, side):
            w, rows = side.values("w"), np.zeros(len(asks), np.int64)
            for i, j in asks.near(side, eps):
                a, b = asks.parts[i], side.parts[j]
                if rows[a].min() < least:
                    rows[a] += pairwise_within(asks.x[a], side.x[b], eps, metric) @ w[b]
            return pa.table({"id": asks.values("id"), "rows": rows})

        def link(side):
            root, ids = np.arange(len(side)), side.values("id")
            for i, j in side.near(side, eps):
                if i <= j:
                    root = _linked(root, side, i, side, j, np.arange(len(side)), np.arange(len(side)), eps, metric)
            first = np.full(len(side), np.iinfo(np.int64).max)
            np.minimum.at(first, root, ids)
            size = np.bincount(root, minlength=len(side))
            return side.table.append_column("label", pa.array(first[root])).append_column("size", pa.array(size[root]))

        def bridge(asks, side):
            mine, theirs = asks.values("label"), side.values("label")
            nodes, at = np.unique(np.concatenate([mine, theirs]), return_inverse=True)
            root = np.arange(len(nodes))
            for i, j in asks.near(side, eps):
                root = _linked(root, asks, i, side, j, at[: len(mine)], at[len(mine) :], eps, metric)
            moved = np.flatnonzero(root != np.arange(len(nodes)))
            return pa.table({"a": nodes[moved], "b": nodes[root[moved]]})

        def touch(asks, side):
            cluster, best = side.values("cluster"), np.full(len(asks), np.inf)
            for i, j in asks.near(side, eps):
                a, b = asks.parts[i], side.parts[j]
                if best[a].max() > cluster[b].min():
                    close = pairwise_within(asks.x[a], side.x[b], eps, metric)
                    best[a] = np.minimum(best[a], np.where(close, cluster[b][None, :], np.inf).min(axis=1))
            reached = np.flatnonzero(best < np.inf)
            return pa.table({"id": asks.values("id")[reached], "cluster": best[reached]})

        schema = blocks.points.schema
        counted = durable(blocks.inside(blocks.points, count, _with(schema, rows="long")))
        enough = F.col("rows") >= least
        marked = counted.withColumn("is_core", enough).drop("rows")
        if blocks.count > 1:
            short = counted.filter(~enough)
            more = blocks.across(short, counted, ["id", "w", "x"], total, "id long, rows long")
            more = more.groupBy("id").agg(F.sum("rows").alias("rows"))
            found = short.drop("rows").join(more, "id", "left").withColumn("is_core", F.coalesce(enough, F.lit(False)))
            marked = durable(marked.filter("is_core").unionByName(found.drop("rows")))
        core = marked.filter("is_core").drop("is_core")
        linked = durable(blocks.inside(core, link, _with(schema, label="long", size="long")))
        names = _bridged(blocks, linked, bridge, n)
        numbers = with_row_index(names.select("root").distinct(), ["root"], "cluster")
        per_root = names.groupBy("root").agg(F.count(F.lit(1)).alias("labels"))
        busy = hot_keys(per_root, ["root"], "labels", n)
        clusters = skew_join(names, numbers, ["root"], busy).select("label", F.col("cluster").cast("double"))
        # A label stays inside its block, so none has many rows.
        core = durable(linked.join(clusters, "label"))
        rest = marked.filter(~F.col("is_core"))
        border = blocks.across(rest.withColumn("cluster", F.lit(-1.0)), core, ["id", "x", "cluster"], touch, "id long, cluster double")
        border = border.groupBy("id").agg(F.min("cluster").alias("cluster"))
        rest = rest.select("id").join(border, "id", "left").select(
            "id", F.coalesce("cluster", F.lit(-1.0)).alias("cluster"), F.lit(False).alias("is_core")
        )
        return core.select("id", "cluster", F.lit(True).alias("is_core")).unionByName(rest)


def _with(schema: T.StructType, **more: str) -> T.StructType:
    return T.StructType([*schema.fields, *T.StructType.fromDDL(", ".join(f"{k} {v}" for k, v in more.items())).fields])


def _linked(root, left, i, right, j, mine, theirs, eps, metric):
    """``root`` (least node of each node's cluster) after the links between two parts.

    ``mine`` and ``theirs`` are the nodes of the points of both sides. Each round takes one link per
    point to another cluster, until none is left, so a crowded pair of parts costs no list of its links.
    """
    a, b = left.parts[i], right.parts[j]
    p, q = mine[a], theirs[b]
    if (root[p] == root[p[0]]).all() and (root[q] == root[p[0]]).all():
        return root
    close = pairwise_within(left.x[a], right.x[b], eps, metric)
    while True:
        close &= root[p][:, None] != root[q][None, :]
        some = np.flatnonzero(close.any(axis=1))
        if not len(some):
            return root
        nodes, roots = least_node(root[p[some]], root[q[close[some].argmax(axis=1)]])
        moved = np.arange(len(root))
        moved[nodes] = roots
        root = moved[root]


def _bridged(blocks: Blocks, linked: DataFrame, bridge, n: int) -> DataFrame:
    """``label, root``: the least label of all that are linked, for the labels that core points have inside their blocks."""
    labels = durable(linked.groupBy("label").agg(F.max("size").alias("size")))
    if blocks.count == 1:
        return labels.select("label", F.col("label").alias("root"))
    columns, schema = ["x", "label"], "a long, b long"

    def joined(names, edges):
        """``names`` with the roots that the edges between roots leave."""
        found = connected_components(edges).select(F.col("node").alias("root"), F.col("label").alias("_to"))
        roots = names.groupBy("root").agg(F.count(F.lit(1)).alias("labels"))
        to = roots.join(found, "root", "left").select("root", F.coalesce("_to", "root").alias("_to"))
        both = skew_join(names, to, ["root"], hot_keys(roots, ["root"], "labels", n))
        return durable(both.drop("root").withColumnRenamed("_to", "root"))

    # Some points of each larger label show most of what belongs together ...
    chosen = F.pmod(F.xxhash64("id", F.lit(1)), F.col("size")) < PROBES
    probes = linked.filter((F.col("size") >= 4 * PROBES) & chosen)
    names = joined(labels.withColumn("root", F.col("label")), blocks.across(probes, linked, columns, bridge, schema))
    # ... and any other link has an end outside of the largest cluster.
    largest = names.groupBy("root").agg(F.sum("size").alias("size")).orderBy(F.desc("size"), "root").head()
    if largest is None:
        return names
    known = durable(linked.join(names.select("label", "root"), "label").drop("label").withColumnRenamed("root", "label"))
    outside = known.filter(F.col("label") != largest["root"])
    return joined(names, blocks.across(outside, known, columns, bridge, schema))


def region_query(
    ds: TabularDataset, point: Sequence[float], eps: float, metric: str = "euclidean"
) -> DataFrame:
    """The rows within ``eps`` of one point, its own copies included."""
    if len(point) != ds.features.width:
        raise ValueError(f"the point must have {ds.features.width} coordinates")
    distance = {"euclidean": euclidean, "manhattan": manhattan}[metric]
    return ds.df.filter(distance(ds.features.operand(), list(point)) <= F.lit(float(eps)))


def index_rows(ds: TabularDataset) -> DataFrame:
    """The rows of ``ds`` with their position and feature vector."""
    if not ds.order_by:
        raise ValueError("cluster numbers depend on row order: give order_by")
    return with_row_index(ds.df.withColumn("_x", ds.features.vector()), ds.order_by, "_row")


def dbscan_sweep(
    ds: TabularDataset, grid: Iterable[tuple[float, int]], metric: str = "euclidean"
) -> DataFrame:
    """``eps, min_samples, n_clusters, n_noise, n_core`` per combination.

    All combinations come from one set of distances, see ``reachability``. Row
    order does not matter to the counts.
    """
    settings = [(DBSCAN(e, m, metric).eps, int(m)) for e, m in grid]
    base = ds.df.select(ds.features.vector().alias("x"))
    finite = F.forall("x", lambda v: F.abs(v) < float("inf"))
    seen = base.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("x").isNull() | F.exists("x", lambda v: v.isNull())).alias("bad"),
        F.count_if(~finite).alias("odd"),
    ).head()
    if seen["n"] == 0:
        raise ValueError("input must have at least one sample")
    if seen["bad"]:
        raise ValueError("null in a feature column")
    rows = []
    if settings:
        unique = durable(base.filter(finite).groupBy("x").agg(F.count(F.lit(1)).alias("w")))
        points = durable(unique.withColumn("id", F.monotonically_increasing_id()))
        counts = [(0, 0, 0)] * len(settings)
        if seen["n"] > seen["odd"]:
            counts = count_clusters(points, ds.features.width, settings, metric)
        rows = [(*s, c, noise + seen["odd"], core) for s, (c, noise, core) in zip(settings, counts, strict=True)]
    return ds.df.sparkSession.createDataFrame(
        rows, "eps double, min_samples int, n_clusters long, n_noise long, n_core long"
    )
