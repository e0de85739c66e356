"""Standardisation to zero mean and unit population variance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramspan.functions import safe_divide
from gramspan.plans.gram import Moments, moments
from gramspan.sources import Features, TabularDataset


class StandardScaler:
    """``(x - mean) / std`` per feature.

    ``zero_std='nan'`` (default) keeps IEEE results for a constant column: NaN
    for the constant itself, a signed infinity for any other value.
    ``zero_std='zero'`` maps a constant column to 0.
    """

    def __init__(self, zero_std: str = "nan"):
        if zero_std not in ("nan", "zero"):
            raise ValueError("zero_std must be 'nan' or 'zero'")
        self.zero_std = zero_std

    def fit(self, ds: TabularDataset) -> ScalerModel:
        if ds.features.is_array:
            return self.from_moments(ds.features, moments(ds.df, ds.features))
        cols = ds.features.columns()
        aggs = [F.count(F.lit(1)).alias("n")]
        for j, c in enumerate(cols):
            aggs += [
                F.count(c).alias(f"n{j}"),
                F.avg(c).alias(f"m{j}"),
                F.stddev_pop(c).alias(f"s{j}"),
            ]
        r = ds.df.agg(*aggs).head()
        if r["n"] == 0:
            raise ValueError("input must have at least one sample")
        if any(r[f"n{j}"] != r["n"] for j in range(len(cols))):
            raise ValueError("null in a feature column")
        return ScalerModel(
            ds.features,
            tuple(r[f"m{j}"] for j in range(len(cols))),
            tuple(r[f"s{j}"] for j in range(len(cols))),
            self.zero_std,
        )

    def from_moments(self, features: Features, m: Moments) -> ScalerModel:
        d = features.width
        return ScalerModel(
            features, tuple(map(float, m.mean[:d])), tuple(map(float, m.std[:d])), self.zero_std
        )

    def fit_transform(self, ds: TabularDataset) -> TabularDataset:
        return self.fit(ds).transform(ds)


@dataclass(frozen=True)
class ScalerModel:
    features: Features
    means: tuple[float, ...]
    stds: tuple[float, ...]
    zero_std: str = "nan"

    def _scaled(self, c, mean: float, std: float):
        diff = c - F.lit(mean)
        if std != 0.0:
            return diff / F.lit(std)
        if self.zero_std == "zero":
            return F.when(c.isNotNull(), F.lit(0.0))
        return safe_divide(diff, F.lit(0.0))

    def transform(self, data):
        """Replace the feature columns of a DataFrame or dataset, lazily."""
        if isinstance(data, TabularDataset):
            return data.with_df(self.transform(data.df))
        self.features.check(data)
        if self.features.is_array:
            x = self.features.vector()
            means = F.array(*map(F.lit, self.means))
            if self.zero_std == "nan":
                diff = F.zip_with(x, means, lambda a, m: a - m)
                out = F.zip_with(diff, F.array(*map(F.lit, self.stds)), safe_divide)
            else:
                stds = F.array(*[F.lit(s or float("inf")) for s in self.stds])
                out = F.zip_with(F.zip_with(x, means, lambda a, m: a - m), stds, lambda a, s: a / s)
            return data.withColumn(self.features.names[0], out)
        return data.withColumns(
            {
                name: self._scaled(c, m, s)
                for name, c, m, s in zip(
                    self.features.names, self.features.columns(), self.means, self.stds, strict=True
                )
            }
        )

    def params(self, spark) -> DataFrame:
        rows = list(zip(self.features.labels(), self.means, self.stds, strict=True))
        return spark.createDataFrame(rows, "feature string, mean double, std double")
