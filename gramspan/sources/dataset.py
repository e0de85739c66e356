"""The data model: a DataFrame with named features, a label and an order."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramspan.plans.ordering import OrderedKeys


@dataclass(frozen=True)
class Features:
    """``d`` numeric columns, or one array column holding ``d`` numbers."""

    names: tuple[str, ...]
    width: int
    is_array: bool = False

    @staticmethod
    def of(df: DataFrame, features: str | Sequence[str]) -> Features:
        if isinstance(features, str):
            features = [features]
        names = tuple(features)
        if not names:
            raise ValueError("at least one feature is needed")
        missing = [c for c in names if c not in df.columns]
        if missing:
            raise ValueError(f"feature columns not found: {missing}")
        first = df.schema[names[0]].dataType
        if isinstance(first, T.ArrayType):
            if len(names) != 1:
                raise ValueError("array features must be a single column")
            row = df.select(F.size(names[0]).alias("d")).filter("d >= 0").head()
            if row is None:
                raise ValueError("input must have at least one sample")
            return Features(names, int(row["d"]), True)
        for c in names:
            if not isinstance(df.schema[c].dataType, T.NumericType):
                raise ValueError(f"feature column {c} is not numeric")
        return Features(names, len(names))

    def check(self, df: DataFrame) -> None:
        """Raise when ``df`` lacks a feature column this was bound to."""
        missing = [c for c in self.names if c not in df.columns]
        if missing:
            raise ValueError(f"feature columns not found: {missing}")
        if self.is_array != isinstance(df.schema[self.names[0]].dataType, T.ArrayType):
            raise ValueError(f"feature column {self.names[0]} changed its type")

    def vector(self) -> Column:
        """The features as one ``array<double>``; a wrong length is an error."""
        if not self.is_array:
            return F.array(*self.columns())
        c = F.col(self.names[0])
        message = f"{self.names[0]} does not hold {self.width} features"
        wrong = F.raise_error(F.lit(message)).cast("array<double>")
        # A null array stays null: fits count it and report it.
        return F.when(F.size(c) != self.width, wrong).otherwise(
            F.transform(c, lambda v: v.cast("double"))
        )

    def columns(self) -> list[Column]:
        if self.is_array:
            c = F.col(self.names[0])
            return [F.get(c, j).cast("double") for j in range(self.width)]
        return [F.col(c).cast("double") for c in self.names]

    def operand(self) -> Column | list[Column]:
        """The cheapest form for ``gramspan.functions``: list or array."""
        return self.vector() if self.is_array else self.columns()

    def labels(self) -> list[str]:
        """One printable name per feature."""
        if self.is_array:
            return [f"{self.names[0]}[{j}]" for j in range(self.width)]
        return list(self.names)


@dataclass(frozen=True)
class TabularDataset:
    """A DataFrame plus the roles of its columns.

    Features and label live in the same rows, so their lengths always agree.
    ``order_by`` names the key that defines row positions; it must identify
    rows, because a DataFrame has no order of its own.
    """

    df: DataFrame
    features: Features
    label: str | None = None
    order_by: tuple[str, ...] = ()

    def __init__(self, df, features, label=None, order_by=()):
        if not isinstance(features, Features):
            features = Features.of(df, features)
        if label is not None and label not in df.columns:
            raise ValueError(f"label column not found: {label}")
        if isinstance(order_by, str):
            order_by = (order_by,)
        object.__setattr__(self, "df", df)
        object.__setattr__(self, "features", features)
        object.__setattr__(self, "label", label)
        object.__setattr__(self, "order_by", tuple(order_by))

    def with_df(self, df: DataFrame) -> TabularDataset:
        return replace(self, df=df)

    def n_samples(self) -> int:
        return self.df.count()

    def n_features(self) -> int:
        return self.features.width

    def shape(self) -> DataFrame:
        return self.df.agg(F.count(F.lit(1)).alias("n_samples")).withColumn(
            "n_features", F.lit(self.features.width).cast("long")
        )

    def train_test_split(
        self, test_size: float, shuffle: bool = False, seed: int | None = None
    ) -> tuple[TabularDataset, TabularDataset]:
        """First rows train, last ``round(n * test_size)`` rows test.

        Only key columns around the cut are sorted. The two sides are plain range filters
        on the key, so they are pushed into the scan and copy no data.
        ``shuffle=True`` gives a random split of about that proportion instead.
        """
        if not 0.0 < test_size < 1.0:
            raise ValueError(f"the test share is {test_size}, outside 0 to 1")
        if shuffle:
            train, test = self.df.randomSplit([1.0 - test_size, test_size], seed=seed)
            return self.with_df(train), self.with_df(test)
        if not self.order_by:
            raise ValueError("an ordered split needs order_by")
        ordered = OrderedKeys(self.df, self.order_by, near=1.0 - test_size)
        n_test = math.floor(ordered.n * test_size + 0.5)
        train, test = ordered.cut(ordered.n - n_test)
        return self.with_df(train), self.with_df(test)
