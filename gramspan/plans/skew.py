"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more than 1/HOT_SHARE of the rows is hot: fewer than HOT_SHARE
# keys can be, which bounds what is broadcast.
HOT_SHARE = 200
# Below this many rows in all, no key is worth special treatment.
MIN_ROWS = 2_000_000


def hot_keys(counts: DataFrame, keys: Sequence[str], weight: str, rows: int) -> DataFrame | None:
    """The hot keys of a frame of ``rows`` rows, given its rows per key."""
    if rows <= MIN_ROWS:
        return None
    return counts.filter(F.col(weight) > rows // HOT_SHARE).select(*keys)


def skew_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], hot: DataFrame | None
) -> DataFrame:
    """Inner join; ``hot`` holds the few keys with very many ``left`` rows.

    ``right`` must hold a bounded number of rows per key. Those of the hot
    keys are broadcast, so hot ``left`` rows are never brought together.
    """
    keys = list(keys)
    if hot is None:
        return left.join(right, keys)
    hot = F.broadcast(hot)
    cold = left.join(hot, keys, "left_anti").join(right, keys)
    few = F.broadcast(right.join(hot, keys, "left_semi"))
    return cold.unionByName(left.join(hot, keys, "left_semi").join(few, keys))
