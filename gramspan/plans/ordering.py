"""Row positions over a distributed frame.

Nothing here sorts in one task: the key is range-partitioned, positions inside
a partition come from the sorted partition itself, and only one count per
partition reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramspan.session import durable

# monotonically_increasing_id keeps the partition above this bit.
_PARTITION_SHIFT = 33
# Key types whose quantiles order like the key itself.
_QUANTILE_TYPES = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)
# Quantile error is 1 / accuracy of the rows; the bracket is twice as wide.
_ACCURACY = 10_000
_BRACKET = 2.0 / _ACCURACY
# Positions below this are fetched with a distributed top-k.
TOP_K_LIMIT = 2_000


def _tie(df: DataFrame, order_by: Sequence[str]) -> list:
    """Order among rows with equal keys: the same on every path, and reproducible."""
    others = [c for c in df.columns if c not in order_by]
    return [F.xxhash64(*others)] if others else []


def _numbered(df: DataFrame, order_by: Sequence[str], name: str) -> tuple[DataFrame, int]:
    """``df`` with its 0-based position in key order, and the row count.

    The sorted frame is checkpointed before it is counted, so a lost executor
    cannot renumber rows between the count and the use.
    """
    keys = [F.col(c) for c in order_by]
    tie = _tie(df, order_by)
    placed = durable(
        df.repartitionByRange(*keys, *tie)
        .sortWithinPartitions(*keys, *tie)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    part = F.shiftright("_mid", _PARTITION_SHIFT).cast("long")
    counts = sorted(
        (r["_part"], r["_n"])
        for r in placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).collect()
    )
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total))
        total += n
    # One row per partition of the sorted frame.
    table = df.sparkSession.createDataFrame(offsets, "_part long, _offset long")
    position = F.col("_mid").bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1)) + F.col("_offset")
    out = (
        placed.withColumn("_part", part)
        .join(F.broadcast(table), "_part")
        .select(*df.columns, position.alias(name))
    )
    return out, total


def with_row_index(df: DataFrame, order_by: Sequence[str], name: str = "row_idx") -> DataFrame:
    return _numbered(df, order_by, name)[0]


class OrderedKeys:
    """The order of a frame, built from its key columns alone.

    ``near`` is the share of rows before the position of interest. When the
    first key column has quantiles, only the rows around that quantile are
    sorted: one scan finds the bracket, one counts it, and the sort sees a
    small part of the keys (or the rows of one very frequent value).
    """

    def __init__(self, df: DataFrame, order_by: Sequence[str], near: float | None = None):
        self.df = df
        self.order_by = list(order_by)
        keys = df.select(*self.order_by)
        lead = F.col(self.order_by[0])
        self.n = self.first = self.last = None
        if near is not None and isinstance(df.schema[self.order_by[0]].dataType, _QUANTILE_TYPES):
            share = [max(near - _BRACKET, 0.0), min(near + _BRACKET, 1.0)]
            seen = keys.agg(
                F.count(F.lit(1)).alias("n"),
                F.count(lead).alias("filled"),
                F.percentile_approx(lead, share, _ACCURACY).alias("ends"),
            ).head()
            self.n = seen["n"]
            # Nulls come first in the order but have no quantile.
            if self.n and seen["filled"] == self.n:
                self._bracket(keys, lead, *seen["ends"])
        if self.first is None:
            self.keys, self.n = _numbered(keys, self.order_by, "_pos")
            self.first, self.last = 0, self.n

    def _bracket(self, keys: DataFrame, lead, low, high) -> None:
        kind = self.df.schema[self.order_by[0]].dataType
        low, high = F.lit(low).cast(kind), F.lit(high).cast(kind)
        before = keys.filter(lead < low).count()
        inside, size = _numbered(keys.filter(lead.between(low, high)), self.order_by, "_pos")
        self.keys = inside.withColumn("_pos", F.col("_pos") + F.lit(before))
        self.first, self.last = before, before + size

    def cut(self, position: int) -> tuple[DataFrame, DataFrame]:
        """Rows before ``position`` and rows from it on."""
        if position <= 0:
            return self.df.filter(F.lit(False)), self.df
        if position >= self.n:
            return self.df, self.df.filter(F.lit(False))
        if not (self.first < position < self.last or (self.first, self.last) == (0, self.n)):
            # The quantile was further off than promised: sort all keys.
            return OrderedKeys(self.df, self.order_by).cut(position)
        edge = self.keys.filter(F.col("_pos").isin(position - 1, position)).orderBy("_pos").collect()
        last, first = (tuple(r[c] for c in self.order_by) for r in edge)
        if last == first:
            # The key does not separate the two rows: fall back to positions.
            rows = with_row_index(self.df, self.order_by, "_pos")
            return (
                rows.filter(F.col("_pos") < position).drop("_pos"),
                rows.filter(F.col("_pos") >= position).drop("_pos"),
            )
        key = F.struct(*self.order_by)
        types = [self.df.schema[c].dataType for c in self.order_by]
        bound = F.struct(
            *[F.lit(v).cast(t).alias(c) for v, t, c in zip(first, types, self.order_by, strict=True)]
        )
        before, after = key < bound, key >= bound
        if first[0] is not None:
            # Implied by the struct comparison; this part reaches the file scan.
            lead, value = F.col(self.order_by[0]), F.lit(first[0]).cast(types[0])
            before = before & (lead.isNull() | (lead <= value))
            after = after & (lead >= value)
        return self.df.filter(before), self.df.filter(after)


def rows_at(df: DataFrame, order_by: Sequence[str], positions: Sequence[int]) -> list:
    """The rows at the given positions, in the order asked for.

    Small positions cost one distributed top-k; large ones sort the keys.
    """
    wanted = sorted(set(positions))
    if wanted[-1] < TOP_K_LIMIT:
        top = df.orderBy(*order_by, *_tie(df, order_by)).limit(wanted[-1] + 1).collect()
        return [top[i] for i in positions]
    hits = with_row_index(df, order_by, "_pos").filter(F.col("_pos").isin(wanted)).collect()
    found = {r["_pos"]: r for r in hits}
    return [found[i] for i in positions]
