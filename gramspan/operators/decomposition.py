"""PCA, truncated SVD and LDA: one Gram scan, one eigenproblem, projections."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramspan.functions import linear, squared_distance
from gramspan.operators.metrics import classification_metrics
from gramspan.plans.gram import Moments, grouped_moments, moments, total
from gramspan.plans.subspace import count_and_mean, leading_eigenpairs, total_scatter
from gramspan.sources import Features, TabularDataset

# Ridge added to the within-class scatter, and the smallest kept eigenvalue.
_LDA_RIDGE = 2e-6
_LDA_MIN_EIGENVALUE = 1e-10


def _top_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:k]
    return np.maximum(values[order], 0.0), vectors[:, order].T


def _orient(components: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Flip signs so that ``component . weights`` is positive.

    A zero product is decided by the first non-zero element.
    """
    out = components.copy()
    for row in out:
        mark = float(row @ weights)
        if abs(mark) <= 1e-12 * max(float(np.abs(weights).max()), 1e-300):
            mark = float(row[np.flatnonzero(np.abs(row) > 1e-12)[0]])
        if mark < 0:
            row *= -1.0
    return out


def _selected_ratio(values: np.ndarray) -> np.ndarray:
    whole = values.sum()
    return values / whole if whole > 0.0 else np.zeros_like(values)


@dataclass(frozen=True)
class Projection:
    """Rows of ``components`` applied to ``x - mean`` (mean may be zero)."""

    features: Features
    components: np.ndarray
    mean: np.ndarray

    def _coordinate(self, row: np.ndarray) -> Column:
        return linear(self.features.operand(), row, -float(row @ self.mean))

    def transform(self, df: DataFrame, output: str = "projected") -> DataFrame:
        """Add the coordinates as one ``array<double>`` column."""
        self.features.check(df)
        return df.withColumn(output, F.array(*[self._coordinate(r) for r in self.components]))

    def inverse_transform(
        self, df: DataFrame, column: str = "projected", output: str = "reconstructed"
    ) -> DataFrame:
        """Map coordinates back to feature space as one ``array<double>``."""
        z = [F.get(column, i) for i in range(len(self.components))]
        back = [
            linear(z, self.components[:, j], float(self.mean[j]))
            for j in range(self.components.shape[1])
        ]
        return df.withColumn(output, F.array(*back))

    def reconstruction_mse(self, m: Moments) -> float:
        """Mean squared error over all cells for the data behind ``m``."""
        d = self.features.width
        gram = m.centered()[:d, :d]
        offset = m.mean[:d] - self.mean
        gram = gram + m.n * np.outer(offset, offset)
        rest = np.eye(d) - self.components.T @ self.components
        return float(np.trace(rest @ gram @ rest.T)) / (m.n * d)

    def score(self, ds: TabularDataset) -> float:
        """Negative mean squared reconstruction error."""
        return -self.reconstruction_mse(moments(ds.df, self.features))

    def truncated(self, k: int):
        return replace(self, components=self.components[:k])

    def components_table(self, spark) -> DataFrame:
        rows = [
            (i, name, float(v))
            for i, row in enumerate(self.components)
            for name, v in zip(self.features.labels(), row, strict=True)
        ]
        return spark.createDataFrame(rows, "component int, feature string, weight double")


@dataclass(frozen=True)
class PCAModel(Projection):
    explained_variance: np.ndarray
    total_variance: float
    covariance: np.ndarray

    @property
    def explained_variance_ratio(self) -> np.ndarray:
        """Shares among the selected components, so they sum to one."""
        return _selected_ratio(self.explained_variance)

    @property
    def total_variance_ratio(self) -> np.ndarray:
        """Shares of the variance of all features."""
        if self.total_variance <= 0.0:
            return np.zeros_like(self.explained_variance)
        return self.explained_variance / self.total_variance

    def get_covariance(self) -> np.ndarray:
        return self.covariance

    def truncated(self, k: int):
        return replace(
            self, components=self.components[:k], explained_variance=self.explained_variance[:k]
        )


def _component_count(k: int | None, n: int, d: int) -> int:
    limit = min(n, d)
    k = limit if k is None else k
    if not 1 <= k <= limit:
        raise ValueError(f"n_components={k} must be between 1 and min(n, d)={limit}")
    return k


def _checked_solver(solver: str, k: int | None) -> str:
    if solver not in ("gram", "subspace"):
        raise ValueError("solver must be 'gram' or 'subspace'")
    if solver == "subspace" and k is None:
        raise ValueError("solver 'subspace' needs n_components")
    return solver


def _complete_rows(ds: TabularDataset) -> DataFrame:
    """The feature vectors; a null among them is an error."""
    x = ds.features.vector()
    missing = x.isNull() | F.exists(x, lambda v: v.isNull())
    broken = F.raise_error(F.lit("null in a feature column")).cast("array<double>")
    rows = ds.df.select(F.when(missing, broken).otherwise(x.cast("array<double>")).alias("x"))
    return rows.persist(StorageLevel.MEMORY_AND_DISK)


class PCA:
    """Principal components of the sample covariance (divisor n - 1).

    Every component is oriented so that its elements have a positive sum.
    ``solver='gram'`` takes one scan and a d x d problem on the driver.
    ``solver='subspace'`` is for very many columns: it never forms a d x d matrix,
    takes a scan for each block of its search space, and has no covariance to show.
    """

    def __init__(self, n_components: int | None = None, solver: str = "gram"):
        self.n_components, self.solver = n_components, _checked_solver(solver, n_components)

    def fit(self, ds: TabularDataset) -> PCAModel:
        if self.solver == "subspace":
            return self._fit_subspace(ds)
        return self.from_moments(ds.features, moments(ds.df, ds.features))

    def _fit_subspace(self, ds: TabularDataset) -> PCAModel:
        d, rows = ds.features.width, _complete_rows(ds)
        try:
            n, mean = count_and_mean(rows, d)
            if n == 0:
                raise ValueError("input must have at least one sample")
            k = _component_count(self.n_components, n, d)
            values, vectors = leading_eigenpairs(rows, d, mean, k)
            whole = total_scatter(rows, d, mean)
        finally:
            rows.unpersist()
        share = max(n - 1, 1)
        return PCAModel(ds.features, _orient(vectors, np.ones(d)), mean, values / share, whole / share, None)

    def from_moments(self, features: Features, m: Moments) -> PCAModel:
        d = features.width
        k = _component_count(self.n_components, m.n, d)
        cov = m.centered()[:d, :d] / max(m.n - 1, 1)
        values, vectors = _top_eigenpairs(cov, k)
        return PCAModel(
            features, _orient(vectors, np.ones(d)), m.mean[:d], values, float(np.trace(cov)), cov
        )

    def fit_transform(self, ds: TabularDataset, output: str = "projected") -> DataFrame:
        return self.fit(ds).transform(ds.df, output)


@dataclass(frozen=True)
class TruncatedSVDModel(Projection):
    singular_values: np.ndarray
    n: int

    @property
    def explained_variance(self) -> np.ndarray:
        """``sigma^2 / (n - 1)``; infinite for a single row."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return self.singular_values**2 / float(self.n - 1)

    @property
    def explained_variance_ratio(self) -> np.ndarray:
        return _selected_ratio(self.singular_values**2)

    def truncated(self, k: int):
        return replace(self, components=self.components[:k], singular_values=self.singular_values[:k])


class TruncatedSVD:
    """Leading right singular vectors of the uncentred data; the solvers are those of ``PCA``."""

    def __init__(self, n_components: int, solver: str = "gram"):
        self.n_components, self.solver = n_components, _checked_solver(solver, n_components)

    def fit(self, ds: TabularDataset) -> TruncatedSVDModel:
        if self.solver == "subspace":
            return self._fit_subspace(ds)
        return self.from_moments(ds.features, moments(ds.df, ds.features))

    def _fit_subspace(self, ds: TabularDataset) -> TruncatedSVDModel:
        d, rows = ds.features.width, _complete_rows(ds)
        try:
            n, mean = count_and_mean(rows, d)
            if n == 0:
                raise ValueError("input must have at least one sample")
            k = _component_count(self.n_components, n, d)
            values, vectors = leading_eigenpairs(rows, d, np.zeros(d), k)
        finally:
            rows.unpersist()
        weights = np.ones(d) if n > d else mean * n
        return TruncatedSVDModel(ds.features, _orient(vectors, weights), np.zeros(d), np.sqrt(values), n)

    def from_moments(self, features: Features, m: Moments) -> TruncatedSVDModel:
        d = features.width
        k = _component_count(self.n_components, m.n, d)
        values, vectors = _top_eigenpairs(m.raw()[:d, :d], k)
        # With few rows the sign follows the left vectors: sum(u) ~ v . sum(x).
        weights = np.ones(d) if m.n > d else m.raw_sums()[:d]
        return TruncatedSVDModel(
            features, _orient(vectors, weights), np.zeros(d), np.sqrt(values), m.n
        )

    def fit_transform(self, ds: TabularDataset, output: str = "projected") -> DataFrame:
        return self.fit(ds).transform(ds.df, output)


@dataclass(frozen=True)
class LDAModel(Projection):
    classes: tuple[float, ...]
    class_means: np.ndarray
    eigenvalues: np.ndarray
    explained_variance_ratio: np.ndarray

    def predicted_class(self) -> Column:
        """Class with the nearest projected mean; ties go to the lowest."""
        z = [self._coordinate(r) for r in self.components]
        means = self.class_means @ self.components.T
        options = [
            F.struct(squared_distance(z, list(mu)).alias("dist"), F.lit(float(c)).alias("label"))
            for c, mu in zip(self.classes, means, strict=True)
        ]
        return F.array_min(F.array(*options))["label"]

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        self.features.check(df)
        return df.withColumn(output, self.predicted_class())

    def score(self, ds: TabularDataset) -> float:
        """Accuracy of the nearest-mean rule."""
        return self.evaluate(ds).head()["accuracy"]

    def evaluate(self, ds: TabularDataset) -> DataFrame:
        pairs = self.predict(ds.df)
        return classification_metrics(pairs, ds.label, "prediction").select("n", "accuracy")


class LDA:
    """Discriminants that maximise between-class over within-class scatter.

    Per-class Grams come from one scan; the d x d problem is whitened by a
    Cholesky factor of the lightly ridged within-class scatter.
    """

    def __init__(self, n_components: int | None = None):
        self.n_components = n_components

    def fit(self, ds: TabularDataset) -> LDAModel:
        if ds.label is None:
            raise ValueError("a label column is needed")
        parts = grouped_moments(ds.df, ds.features, ds.label)
        if len(parts) < 2:
            raise ValueError("LDA needs at least two classes")
        d, whole = ds.features.width, total(parts)
        wanted = len(parts) - 1 if self.n_components is None else self.n_components
        k = min(wanted, len(parts) - 1)
        if k < 1:
            raise ValueError("at least one component has to be asked for")
        means = np.array([m.mean for m in parts.values()])
        within = sum(m.centered() for m in parts.values())
        gaps = means - whole.mean
        between = (gaps.T * [m.n for m in parts.values()]) @ gaps
        chol = np.linalg.cholesky(within + _LDA_RIDGE * np.eye(d))
        half = np.linalg.solve(chol, between)
        values, vectors = np.linalg.eigh(np.linalg.solve(chol, half.T))
        order = [i for i in np.argsort(-values, kind="stable") if values[i] > _LDA_MIN_EIGENVALUE]
        if not order:
            raise ValueError("no direction separates the classes")
        chosen = order[:k]
        raw = np.linalg.solve(chol.T, vectors[:, chosen]).T
        raw /= np.linalg.norm(raw, axis=1, keepdims=True)
        return LDAModel(
            ds.features,
            _orient(raw, np.ones(d)),
            np.zeros(d),
            tuple(parts),
            means,
            values[chosen],
            values[chosen] / values[order].sum(),
        )

    def fit_transform(self, ds: TabularDataset, output: str = "projected") -> DataFrame:
        return self.fit(ds).transform(ds.df, output)


def reconstruction_comparison(ds: TabularDataset, ks: Sequence[int]) -> DataFrame:
    """``method, k, mse, variance_kept`` for PCA and SVD, from one scan."""
    m = moments(ds.df, ds.features)
    top = max(ks)
    pca = PCA(top).from_moments(ds.features, m)
    svd = TruncatedSVD(top).from_moments(ds.features, m)
    d = ds.features.width
    energy = float(np.trace(m.raw()[:d, :d]))
    rows = []
    for k in ks:
        rows.append(
            ("pca", k, pca.truncated(k).reconstruction_mse(m), float(pca.total_variance_ratio[:k].sum()))
        )
        kept = float((svd.singular_values[:k] ** 2).sum()) / energy if energy > 0 else 0.0
        rows.append(("svd", k, svd.truncated(k).reconstruction_mse(m), kept))
    return ds.df.sparkSession.createDataFrame(
        rows, "method string, k int, mse double, variance_kept double"
    )
