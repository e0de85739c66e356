"""Which points lie within ``eps`` of each other, without listing all pairs.

Low dimension: points fall into grid cells whose diagonal is ``eps``. A cell is
summarised by its count and its tight bounding box, and only summaries of
neighbouring cells are joined. A box wholly inside or outside the radius is
settled at once; what straddles it is settled on points, and pairs of crowded
cells by subdividing both, so no crowded cell is ever paired point by point.

High dimension: points that are near each other share a block of bounded size. A task holds
one block or two, and compares their parts by matrix products, as far as centres, radii and
boxes of the parts leave something in reach; only per-point results leave a task.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gramspan.functions import linear
from gramspan.plans.gram import arrow_matrix, moments
from gramspan.plans.skew import hot_keys, skew_join
from gramspan.session import durable
from gramspan.sources import Features

# Widest input handled with full-dimensional cells.
GRID_WIDTH = 3
# Point pairs up to which one pair of (sub)cells is finished directly.
DIRECT_PAIRS = 4096
# Points per block in the blocked comparison, and coordinates per block.
BLOCK_ROWS, BLOCK_VALUES = 16_384, 1 << 20
# Points per part of a block, which one matrix product takes.
PART_ROWS = 1024
# Balls that points are parted into, and points that their centres are chosen from.
BALLS, SAMPLE = 256, 16_384


# --- metric on columns ----------------------------------------------------


def _combine(metric: str, gaps: list[Column]) -> Column:
    total = None
    for g in gaps:
        term = g * g if metric == "euclidean" else g
        total = term if total is None else total + term
    return F.sqrt(total) if metric == "euclidean" else total


def point_distance(metric: str, a: list[Column], b: list[Column]) -> Column:
    return _combine(metric, [F.abs(x - y) for x, y in zip(a, b, strict=True)])


def box_range(metric: str, alo, ahi, blo, bhi) -> tuple[Column, Column]:
    """Least and greatest possible distance between two boxes."""
    near, far = [], []
    for al, ah, bl, bh in zip(alo, ahi, blo, bhi, strict=True):
        near.append(F.greatest(bl - ah, al - bh, F.lit(0.0)))
        far.append(F.greatest(bh - al, ah - bl))
    return _combine(metric, near), _combine(metric, far)


def _steps(offsets) -> Column:
    """A literal array of offsets, written as text to build it in one call."""
    rows = ", ".join("array(" + ", ".join(f"{v}L" for v in o) + ")" for o in offsets)
    return F.expr(f"array({rows})")


# --- grid -----------------------------------------------------------------


class Grid:
    """Cells of diagonal ``eps`` over ``d`` coordinate columns ``x0..``."""

    def __init__(self, d: int, eps: float, metric: str):
        self.d, self.eps, self.metric = d, eps, metric
        # A little less than the exact side, so rounding cannot widen a cell.
        self.side = eps / (math.sqrt(d) if metric == "euclidean" else d) * (1 - 1e-6)
        self.x = [f"x{j}" for j in range(d)]
        self.cell = [f"c{j}" for j in range(d)]
        self.lo = [f"lo{j}" for j in range(d)]
        self.hi = [f"hi{j}" for j in range(d)]

    def offsets(self) -> list[tuple[int, ...]]:
        """Cell offsets that can hold a point within ``eps``."""
        reach = int(1 + self.eps / self.side + 1e-6)
        found = []
        for o in itertools.product(range(-reach, reach + 1), repeat=self.d):
            gaps = [max(abs(v) - 1, 0) * self.side for v in o]
            gap = math.hypot(*gaps) if self.metric == "euclidean" else sum(gaps)
            if gap <= self.eps * (1 + 1e-6):
                found.append(o)
        return found

    def place(self, points: DataFrame) -> DataFrame:
        return points.withColumns(
            {
                c: F.floor(F.col(x) / F.lit(self.side)).cast("long")
                for c, x in zip(self.cell, self.x, strict=True)
            }
        )

    def boxes(self) -> list[Column]:
        return [F.min(x).alias(n) for x, n in zip(self.x, self.lo, strict=True)] + [
            F.max(x).alias(n) for x, n in zip(self.x, self.hi, strict=True)
        ]

    def columns(self, names: list[str], prefix: str = "") -> list[Column]:
        return [F.col(prefix + n) for n in names]

    def prefixed(self, df: DataFrame, prefix: str, names: list[str]) -> DataFrame:
        return df.withColumnsRenamed({n: prefix + n for n in names})

    def neighbour_pairs(self, a: DataFrame, b: DataFrame, half: bool = False) -> DataFrame:
        """Pairs of existing cells ``a``, ``b`` whose boxes come within ``eps``.

        Columns of ``a`` get the prefix ``a_`` and of ``b`` ``b_``; ``far``
        tells whether the boxes are entirely within ``eps`` of each other.
        ``half`` keeps each unordered pair of different cells once.
        """
        offs = self.offsets()
        if half:
            offs = [o for o in offs if o > (0,) * self.d]
        left = self.prefixed(a, "a_", a.columns).withColumn("_o", F.explode(_steps(offs)))
        left = left.withColumns(
            {
                "b_" + c: F.col("a_" + c) + F.get("_o", j)
                for j, c in enumerate(self.cell)
            }
        ).drop("_o")
        right = self.prefixed(b, "b_", b.columns)
        joined = left.join(right, ["b_" + c for c in self.cell])
        near, far = box_range(
            self.metric,
            self.columns(self.lo, "a_"),
            self.columns(self.hi, "a_"),
            self.columns(self.lo, "b_"),
            self.columns(self.hi, "b_"),
        )
        return joined.filter(near <= self.eps).withColumn("far", far <= self.eps)


# --- blocks ---------------------------------------------------------------


def ball_centres(sample: np.ndarray, share: float) -> np.ndarray:
    """Centres of a tree of balls over a sample, each sampled point standing for ``share`` points.

    The ball with the most points is split between a far point and the one
    farthest from that, until no ball holds more than a part of a block or there are ``BALLS``.
    """
    balls, open_ = [], [sample]
    while open_ and len(balls) + len(open_) < BALLS:
        open_.sort(key=len)
        points = open_.pop()
        far = points[((points - points.mean(axis=0)) ** 2).sum(axis=1).argmax()]
        other = points[((points - far) ** 2).sum(axis=1).argmax()]
        near = ((points - far) ** 2).sum(axis=1) < ((points - other) ** 2).sum(axis=1)
        if len(points) * share <= min(BLOCK_ROWS, PART_ROWS) or near.all() or not near.any():
            balls.append(points)
        else:
            open_ += [points[near], points[~near]]
    return np.array([x.mean(axis=0) for x in balls + open_])


def _in_balls(points: DataFrame, d: int, centres: np.ndarray) -> DataFrame:
    """``points`` with the nearest centre as ``ball`` and the distance to it as ``gap``."""
    names = points.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema)

    def run(batches):
        for batch in batches:
            x, _ = arrow_matrix(batch.column("x"), d)
            # Only the choice comes from products, which lose digits; the distance is computed plainly.
            score = (centres * centres).sum(axis=1)[None, :] - 2.0 * (x @ centres.T)
            ball = score.argmin(axis=1)
            gap = np.sqrt(((x - centres[ball]) ** 2).sum(axis=1))
            columns = [*batch.columns, pa.array(ball.astype(np.int32)), pa.array(gap)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "ball", "gap"])

    return points.mapInArrow(run, schema + ", ball int, gap double")


def _chain(apart: np.ndarray) -> list[int]:
    """Row numbers of a distance matrix, each followed by the nearest that is left."""
    order, left = [0], np.ones(len(apart), bool)
    left[0] = False
    while left.any():
        order.append(int(np.where(left, apart[order[-1]], np.inf).argmin()))
        left[order[-1]] = False
    return order


class Side:
    """The points of one block in a task, cut into parts of neighbouring points."""

    def __init__(self, table: pa.Table, d: int):
        ball, place = table.column("ball").to_numpy(), table.column("place").to_numpy()
        order = np.lexsort((place, ball))
        self.table, ball = table.take(pa.array(order)).combine_chunks(), ball[order]
        self.x = arrow_matrix(self.table.column("x").combine_chunks(), d)[0]
        # A part ends with its ball, unless it is still small.
        ends = [*np.flatnonzero(np.diff(ball)) + 1, len(ball)]
        starts = [0] if len(ball) else []
        for end in ends if len(ball) else []:
            while end - starts[-1] > PART_ROWS:
                starts.append(starts[-1] + PART_ROWS)
            if end < len(ball) and end - starts[-1] >= PART_ROWS // 8:
                starts.append(end)
        self.parts = [slice(s, e) for s, e in zip(starts, [*starts[1:], len(ball)])]
        boxes = [(x.mean(axis=0), x.min(axis=0), x.max(axis=0)) for x in (self.x[p] for p in self.parts)]
        self.centre, self.lo, self.hi = (np.array(v).reshape(-1, d) for v in (zip(*boxes) if boxes else ((),) * 3))
        far = [((self.x[p] - c) ** 2).sum(axis=1).max() for p, c in zip(self.parts, self.centre)]
        self.radius = np.sqrt(np.array(far, dtype=float))

    def __len__(self) -> int:
        return len(self.x)

    def values(self, name: str) -> np.ndarray:
        return self.table.column(name).to_numpy()

    def near(self, other: Side, eps: float) -> list[tuple[int, int]]:
        """The pairs of parts that may hold points within ``eps``, nearest centres first.

        No two points are closer than the boxes of their parts, nor than the centres less both radii.
        """
        if not self.parts or not other.parts:
            return []
        found = []
        size = max(np.abs(v).max() for v in (self.lo, self.hi, other.lo, other.hi)) * self.lo.shape[1] ** 0.5
        slack = eps * (1 + 1e-6) + 1e-9 * size
        for i in range(len(self.parts)):
            apart = np.sqrt(((other.centre - self.centre[i]) ** 2).sum(axis=1))
            gap = np.maximum(np.maximum(other.lo - self.hi[i], self.lo[i] - other.hi), 0.0)
            keep = (apart <= (self.radius[i] + other.radius) * (1 + 1e-9) + slack) & (np.sqrt((gap * gap).sum(axis=1)) <= slack)
            found += [(apart[j], i, int(j)) for j in np.flatnonzero(keep)]
        return [(i, j) for _, i, j in sorted(found)]


class Blocks:
    """Blocks of bounded size over ``points`` (``id``, ``x``), and which pairs
    of blocks may hold points within ``eps``.

    Two partitions group the points. Coarse
    cells of side ``eps`` along the principal directions: a projection on a unit
    vector never lengthens a distance, in either metric. And balls around
    pivots, which separate clusters in all directions: by the triangle inequality
    two balls are apart if their centres are farther than both radii and ``eps``. Small
    balls share a block and a crowded one becomes as many blocks as it needs, so
    the number of blocks follows the number of points however finely they are
    grouped. The pivots come from a
    sample of bounded size; every point is in its block, so the choice matters to the time alone.
    """

    def __init__(self, points: DataFrame, d: int, eps: float):
        self.d, self.eps, self.rows = d, eps, max(min(BLOCK_ROWS, BLOCK_VALUES // d), 1)
        self._pairs = None
        whole = moments(points, Features(("x",), d, True))
        _, axes = np.linalg.eigh(whole.centered())
        axes = axes.T[::-1][:GRID_WIDTH]
        self.cells = [f"c{i}" for i in range(len(axes))]
        step = max(int(whole.n) // SAMPLE, 1)
        some = points.filter(F.pmod(F.xxhash64("id"), F.lit(step)) == 0).orderBy(F.xxhash64("id")).limit(2 * SAMPLE)
        sample = np.array([r["x"] for r in some.select("x").collect()], dtype=float).reshape(-1, d)
        if not len(sample):
            sample = np.asarray(whole.mean, dtype=float).reshape(1, d)
        centres = ball_centres(sample, float(whole.n) / len(sample))
        # At most BALLS * BALLS distances.
        self.apart = np.sqrt(np.array([((centres - c) ** 2).sum(axis=1) for c in centres]))
        # Coordinates along unit vectors; the slack absorbs their rounding.
        placed = _in_balls(points, d, centres).withColumns(
            {
                c: F.floor(
                    linear(F.col("x"), axis, -float(axis @ whole.mean)) / F.lit(eps * (1 + 1e-6))
                ).cast("long")
                for c, axis in zip(self.cells, axes, strict=True)
            }
        )
        place = ["ball", *self.cells]
        groups = durable(placed.groupBy(*place).agg(F.count(F.lit(1)).alias("size"), F.max("gap").alias("radius")))
        sizes = groups.groupBy("ball").agg(F.sum("size").alias("size")).collect()
        table, self.count = self._dealt({r["ball"]: r["size"] for r in sizes})
        dealt = points.sparkSession.createDataFrame(table, "ball int, base long, parts long, total long")
        upto = F.sum("size").over(Window.partitionBy("ball").orderBy(*self.cells))
        of = lambda at: (F.col("base") + F.floor(at * F.col("parts") / F.col("total"))).cast("long")
        groups = groups.join(F.broadcast(dealt), "ball").withColumn("before", upto - F.col("size"))
        last = F.col("before") + F.col("size") - 1
        self.groups = durable(groups.withColumns({"first": of(F.col("before")), "last": of(last)}))
        hot = hot_keys(self.groups, place, "size", whole.n)
        known = self.groups.select(*place, "size", "before", "base", "parts", "total")
        spread = F.col("before") + F.pmod(F.xxhash64("id"), F.col("size"))
        split = skew_join(placed.drop("gap"), known, place, hot).withColumn("place", spread)
        self.points = split.withColumn("block", of(F.col("place"))).select(*points.columns, "ball", "place", "block")

    def _dealt(self, sizes: dict[int, int]) -> tuple[list[tuple], int]:
        """First block, number of blocks and points of each ball, and the number of all blocks."""
        table, block, held = [], 0, 0
        for ball in _chain(self.apart):
            size = sizes.get(ball, 0)
            if size:
                if held and held + size > self.rows:
                    block, held = block + 1, 0
                parts = -(-size // self.rows)
                table.append((ball, block, parts, size))
                block, held = block + parts - 1, held + size if parts == 1 else self.rows
        return table, block + 1

    @property
    def pairs(self) -> DataFrame:
        """``a, b``: the blocks, ``a <= b``, that hold groups of points which may be within ``eps``."""
        if self._pairs is None:
            self._pairs = durable(self._near_blocks())
        return self._pairs

    def _near_blocks(self) -> DataFrame:
        spark, cells = self.points.sparkSession, self.cells
        if self.count == 1:
            return spark.createDataFrame([(0, 0)], "a long, b long")
        near = list(itertools.product((-1, 0, 1), repeat=len(cells)))
        side = lambda s: [F.col(c).alias(c + s) for c in ("ball", "radius", "first", "last")]
        left = self.groups.select(*cells, *side("_a"), F.explode(_steps(near)).alias("_o"))
        left = left.withColumns({c: F.col(c) + F.get("_o", i) for i, c in enumerate(cells)})
        n = range(len(self.apart))
        gaps = spark.createDataFrame(
            [(i, j, float(self.apart[i, j])) for i in n for j in n], "ball_a int, ball_b int, between double"
        )
        met = left.join(self.groups.select(*cells, *side("_b")), cells).join(F.broadcast(gaps), ["ball_a", "ball_b"])
        slack = self.eps * (1 + 1e-6) + 1e-9 * float(self.apart.max(initial=0.0))
        reach = (F.col("radius_a") + F.col("radius_b")) * (1 + 1e-9) + F.lit(slack)
        ends = ["first_a", "last_a", "first_b", "last_b"]
        spans = met.filter(F.col("between") <= reach).select(*ends).distinct()
        pairs = spans.withColumn("a", F.explode(F.sequence("first_a", "last_a")))
        return pairs.select("a", F.explode(F.sequence("first_b", "last_b")).alias("b")).filter("a <= b").distinct()

    def inside(self, points: DataFrame, fn, schema) -> DataFrame:
        """``fn(side)`` for every block of ``points``, which are ``self.points`` or some of them with other columns."""
        d = self.d
        return points.groupBy("block").applyInArrow(lambda table: fn(Side(table, d)), schema)

    def compare(self, points: DataFrame, columns: list[str], fn, schema: str) -> DataFrame:
        """``fn(left, right)`` for every pair of parts in reach, as Arrow tables.

        ``points`` are ``self.points`` with more columns; ``right`` is None
        for a part paired with itself. A task sees two blocks at a time.
        """
        d, eps = self.d, self.eps
        sides = self.pairs.select("a", "b", F.col("a").alias("block")).unionByName(
            self.pairs.filter("a < b").select("a", "b", F.col("b").alias("block"))
        )
        rows = points.select("block", "ball", "place", *columns).join(sides, "block")

        def run(table: pa.Table) -> pa.Table:
            block, a = table.column("block"), table.column("a")[0].as_py()
            b = table.column("b")[0].as_py()
            left = Side(table.filter(pc.equal(block, a)), d)
            right = left if a == b else Side(table.filter(pc.equal(block, b)), d)
            part = lambda side, i: side.table.slice(side.parts[i].start, side.parts[i].stop - side.parts[i].start)
            # Blocks in reach by their balls alone may have no parts in reach: one pair gives the empty result.
            met = [(i, j) for i, j in left.near(right, eps) if a < b or i <= j] or [(0, 0)]
            return pa.concat_tables(
                fn(part(left, i), None if a == b and i == j else part(right, j)) for i, j in met
            )

        return rows.groupBy("a", "b").applyInArrow(run, schema)

    def across(self, queries: DataFrame, points: DataFrame, columns: list[str], fn, schema: str) -> DataFrame:
        """``fn(query side, point side)`` for all ``queries`` and what ``points`` may be within ``eps``.

        Both are ``self.points``, or some of them, with more columns. Blocks with few
        queries are taken together, so each point meets as few tasks as the queries fill.
        """
        d = self.d
        held = queries.groupBy("block").agg(F.count(F.lit(1)).alias("size"))
        # One row per block.
        before = F.sum("size").over(Window.orderBy("block")) - F.col("size")
        asked = durable(held.select("block", F.floor(before / F.lit(self.rows)).cast("long").alias("a")))
        both = self.pairs.unionByName(self.pairs.filter("a < b").select(F.col("b").alias("a"), F.col("a").alias("b")))
        met = durable(asked.join(both.withColumnRenamed("a", "block"), "block").select("a", "b").distinct())
        names = ["block", "ball", "place", *columns]
        left = queries.select(*names).join(asked, "block").join(met, "a").withColumn("asks", F.lit(True))
        right = points.select(*names).join(met.withColumn("block", F.col("b")), "block").withColumn("asks", F.lit(False))

        def run(table: pa.Table) -> pa.Table:
            asks = table.column("asks")
            return fn(Side(table.filter(asks), d), Side(table.filter(pc.invert(asks)), d))

        rows = left.unionByName(right)
        return rows.groupBy("a", "b").applyInArrow(run, schema)


def pairwise_within(
    a: np.ndarray, b: np.ndarray, eps: float, metric: str
) -> np.ndarray:
    """Boolean matrix of ``distance <= eps``.

    Euclidean distances come from a matrix product; entries too close to the
    limit for its rounding are computed again from coordinate differences.
    """
    if metric == "manhattan":
        out = np.zeros((len(a), len(b)), dtype=bool)
        for i, row in enumerate(a):
            out[i] = np.abs(b - row).sum(axis=1) <= eps
        return out
    # Near the origin the product loses the fewest digits.
    center = a.mean(axis=0) if len(a) else 0.0
    p, q = a - center, b - center
    aa, bb = np.einsum("ij,ij->i", p, p), np.einsum("ij,ij->i", q, q)
    sq = aa[:, None] + bb[None, :] - 2.0 * (p @ q.T)
    limit = eps * eps
    slack = 1e-10 * (aa.max(initial=0.0) + bb.max(initial=0.0) + limit)
    out = sq <= limit
    i, j = np.nonzero(np.abs(sq - limit) <= slack)
    for at in range(0, len(i), 100_000):
        r, c = i[at : at + 100_000], j[at : at + 100_000]
        diff = a[r] - b[c]
        out[r, c] = np.sqrt((diff * diff).sum(axis=1)) <= eps
    return out
