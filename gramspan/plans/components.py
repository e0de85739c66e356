"""Connected components of an edge table.

Edges are reduced to star forests inside each task, and what is left is dealt out
to fewer tasks, as many as it fills, and reduced again. Where that no longer
helps, because most nodes have edges in many tasks, alternating large-star and
small-star rounds go on until every node points at the least node of its
component. No edge reaches the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramspan.plans.skew import hot_keys, skew_join
from gramspan.session import RollingTable, durable

# Edges a task holds while reducing its part.
TASK_EDGES = 1_000_000
# Share of the edges that a reduction must fall below to be worth another.
_SHRINKS = 0.7
_EDGES = "a long, b long"


def least_node(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges ``(a, b)`` and the least node of their component."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        # Hook the current roots as well, so whole trees move at once.
        for side in (left, right):
            np.minimum.at(new, side, low)
            np.minimum.at(new, label[side], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _forest(batches):
    """Replace a task's edges by star edges, a bounded buffer at a time."""

    def reduce(parts):
        a, b = (np.concatenate(side) for side in zip(*parts, strict=True))
        nodes, roots = least_node(a, b)
        inner = nodes != roots
        return nodes[inner], roots[inner]

    parts, held = [], 0
    for batch in batches:
        parts.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        held += batch.num_rows
        if held > 2 * TASK_EDGES:
            parts = [reduce(parts)]
            held = len(parts[0][0])
            if held > TASK_EDGES:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in parts[0]], ["a", "b"])
                parts, held = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in reduce(parts)], ["a", "b"])


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node with an edge to another node.

    ``edges`` has two long columns; ``label`` is the least node reachable.
    """
    a, b = edges.columns
    pairs = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    forest = durable(pairs.filter("a != b").mapInArrow(_forest, _EDGES).distinct())
    stars, before = forest, _fingerprint(forest)
    shrinking = before[0] > 0
    while shrinking:
        # Dealt out to as many tasks as the edges fill; one task that holds them all is done.
        tasks = -(-before[0] // TASK_EDGES)
        stars = durable(stars.repartition(tasks).mapInArrow(_forest, _EDGES).distinct())
        if tasks == 1:
            break
        after = _fingerprint(stars)
        shrinking, before = after[0] < _SHRINKS * before[0], after
    if before[0] and not shrinking:
        stars = _star_rounds(stars, before)
    roots = stars.select(F.col("b").alias("node")).distinct().withColumn("label", F.col("node"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)


def _star_rounds(stars: DataFrame, before: tuple) -> DataFrame:
    """Alternating rounds until nothing changes."""
    table = RollingTable(stars.sparkSession)
    while True:
        stars = table.advance(_small_star(_large_star(stars, before[0]), before[0]))
        after = _fingerprint(stars)
        if after == before:
            break
        before = after
    stars = durable(stars)
    table.close()
    return stars


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of edges and a sum that changes with any of them."""
    r = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).head()
    return r["n"], r["h"]


def _with_least(neighbours: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Attach to each ``(u, v)`` the least of ``u`` and its neighbours."""
    least = neighbours.groupBy("u").agg(
        F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("w")
    )
    hot = hot_keys(least, ["u"], "w", rows)
    return skew_join(neighbours, least.drop("w"), ["u"], hot), least


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    joined, _ = _with_least(both, 2 * rows)
    return joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    joined, least = _with_least(down, rows)
    moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(own).filter("a != b").distinct()
