"""Linear regression family: one Gram scan, then a d x d problem.

Any number of models (alphas, penalties, with or without intercept) can be
solved from the same ``Moments``; R2 on a data set is a function of its Gram
too, so sweeps never rescan rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramspan.functions import linear
from gramspan.operators.metrics import r2_score, regression_metrics
from gramspan.plans.gram import Moments, moments
from gramspan.sources import Features, TabularDataset

# A scaled column or pivot below this is treated as zero.
_TINY = 1e-10


class RegressionModel(Protocol):
    """What every fitted regression offers."""

    coefficients: np.ndarray
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame: ...

    def score(self, ds: TabularDataset) -> float: ...


@dataclass(frozen=True)
class LinearModel:
    """``prediction = x . coefficients + intercept`` as a projection."""

    features: Features
    coefficients: np.ndarray
    intercept: float
    n_sweeps: int = 0

    def prediction(self):
        return linear(self.features.operand(), self.coefficients, self.intercept)

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        self.features.check(df)
        return df.withColumn(output, self.prediction())

    predict = transform

    def score(self, ds: TabularDataset) -> float:
        return r2_score(self.transform(ds.df), ds.label, "prediction")

    def evaluate(self, ds: TabularDataset) -> DataFrame:
        """Lazy one-row frame ``n, mse, mae, r2``."""
        return regression_metrics(self.transform(ds.df), ds.label, "prediction")

    def params(self, spark) -> DataFrame:
        rows = [("intercept", float(self.intercept))]
        rows += list(zip(self.features.labels(), map(float, self.coefficients), strict=True))
        return spark.createDataFrame(rows, "term string, value double")

    def r2_from(self, m: Moments) -> float:
        """R2 on the data set whose moments (label last) are ``m``."""
        beta = np.append(-self.coefficients, 1.0)
        # residual = beta . z - intercept, with mean and centred part apart.
        centred = m.centered()
        offset = float(beta @ m.mean) - self.intercept
        ss_res = float(beta @ centred @ beta) + m.n * offset * offset
        ss_tot = float(centred[-1, -1])
        if ss_tot == 0.0:
            return 1.0
        return 1.0 - ss_res / ss_tot


class _LinearEstimator:
    fit_intercept = True
    normalize = False

    def fit(self, ds: TabularDataset) -> LinearModel:
        if ds.label is None:
            raise ValueError("a label column is needed")
        return self.from_moments(ds.features, moments(ds.df, ds.features, ds.label))

    def from_moments(self, features: Features, m: Moments) -> LinearModel:
        d = features.width
        whole = m.centered() if self.fit_intercept else m.raw()
        gram, rhs = whole[:d, :d], whole[:d, d]
        scale = np.ones(d)
        flat = np.zeros(d, dtype=bool)
        if self.normalize:
            std = m.std[:d]
            flat = std <= _TINY
            scale = np.where(flat, 1.0, std)
            gram, rhs = gram / np.outer(scale, scale), rhs / scale
        beta, sweeps = self._solve(gram, rhs, m.n)
        beta = np.where(flat, 0.0, beta / scale)
        intercept = float(m.mean[d] - beta @ m.mean[:d]) if self.fit_intercept else 0.0
        return LinearModel(features, beta, intercept, sweeps)

    def _solve(self, gram, rhs, n) -> tuple[np.ndarray, int]:
        raise NotImplementedError


def _unit_diagonal(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = np.sqrt(np.maximum(np.diag(gram), 0.0))
    s = np.where(s > 0.0, s, 1.0)
    return gram / np.outer(s, s), s


def _finite(*arrays) -> bool:
    return all(np.isfinite(a).all() for a in arrays)


class LinearRegression(_LinearEstimator):
    """Least squares. Collinear columns get the minimum-norm solution."""

    def __init__(self, fit_intercept: bool = True):
        self.fit_intercept = fit_intercept

    def _solve(self, gram, rhs, n):
        if not _finite(gram, rhs):
            return np.full(len(rhs), np.nan), 0
        unit, s = _unit_diagonal(gram)
        cut = len(rhs) * 1e-13
        if np.linalg.eigvalsh(unit)[0] > cut:
            return np.linalg.solve(unit, rhs / s) / s, 0
        values, vectors = np.linalg.eigh(gram)
        keep = values > max(values[-1], 0.0) * cut
        part = vectors[:, keep]
        return part @ ((part.T @ rhs) / values[keep]), 0


class Ridge(_LinearEstimator):
    """``(X'X + alpha I) beta = X'y``; a singular system is an error."""

    def __init__(self, alpha: float = 1.0, fit_intercept: bool = True, normalize: bool = False):
        if alpha < 0:
            raise ValueError(f"alpha must be >= 0, got {alpha}")
        self.alpha, self.fit_intercept, self.normalize = alpha, fit_intercept, normalize

    def _solve(self, gram, rhs, n):
        system = gram + self.alpha * np.eye(len(rhs))
        if not _finite(system, rhs):
            return np.full(len(rhs), np.nan), 0
        unit, s = _unit_diagonal(system)
        if np.diag(system).min() < _TINY or np.linalg.eigvalsh(unit)[0] <= len(rhs) * 1e-14:
            raise ValueError("matrix is singular or nearly singular")
        return np.linalg.solve(unit, rhs / s) / s, 0


def coordinate_descent(
    gram: np.ndarray, rhs: np.ndarray, n: int, l1: float, l2: float, max_iter: int, tol: float
) -> tuple[np.ndarray, int]:
    """Minimise ``|y - Xb|^2 / 2n + l1 |b|_1 + l2/2 |b|^2`` on the Gram.

    Stops when the summed change of a sweep is below ``tol``.
    """
    d = len(rhs)
    beta = np.zeros(d)
    diag = np.diag(gram)
    active = [j for j in range(d) if diag[j] >= _TINY]
    for sweep in range(1, max_iter + 1):
        moved = 0.0
        for j in active:
            rho = (rhs[j] - gram[j] @ beta + diag[j] * beta[j]) / n
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (diag[j] / n + l2)
            moved += abs(new - beta[j])
            beta[j] = new
        if moved < tol:
            return beta, sweep
    return beta, max_iter


class ElasticNet(_LinearEstimator):
    def __init__(
        self,
        alpha: float = 1.0,
        l1_ratio: float = 0.5,
        fit_intercept: bool = True,
        normalize: bool = False,
        max_iter: int = 1000,
        tolerance: float = 1e-4,
    ):
        if alpha < 0:
            raise ValueError(f"alpha must be >= 0, got {alpha}")
        if not 0.0 <= l1_ratio <= 1.0:
            raise ValueError(f"l1_ratio must be between 0 and 1, got {l1_ratio}")
        self.alpha, self.l1_ratio = alpha, l1_ratio
        self.fit_intercept, self.normalize = fit_intercept, normalize
        self.max_iter, self.tolerance = max_iter, tolerance

    @property
    def l1_penalty(self) -> float:
        return self.alpha * self.l1_ratio

    @property
    def l2_penalty(self) -> float:
        return self.alpha * (1.0 - self.l1_ratio)

    def _solve(self, gram, rhs, n):
        return coordinate_descent(
            gram, rhs, n, self.l1_penalty, self.l2_penalty, self.max_iter, self.tolerance
        )


class Lasso(ElasticNet):
    """L1-penalised regression: an elastic net without its squared penalty."""

    def __init__(
        self,
        alpha: float = 1.0,
        fit_intercept: bool = True,
        normalize: bool = False,
        max_iter: int = 1000,
        tolerance: float = 1e-4,
    ):
        super().__init__(alpha, 1.0, fit_intercept, normalize, max_iter, tolerance)


def compare_models(
    train: TabularDataset, test: TabularDataset, models: dict[str, _LinearEstimator]
) -> DataFrame:
    """``model, train_r2, test_r2, intercept, coefficients`` per estimator.

    Two scans in all, one per side, whatever the number of models.
    """
    m_train = moments(train.df, train.features, train.label)
    m_test = moments(test.df, test.features, test.label)
    rows = []
    for name, estimator in models.items():
        fitted = estimator.from_moments(train.features, m_train)
        rows.append(
            (
                name,
                fitted.r2_from(m_train),
                fitted.r2_from(m_test),
                float(fitted.intercept),
                [float(b) for b in fitted.coefficients],
            )
        )
    schema = "model string, train_r2 double, test_r2 double, intercept double, coefficients array<double>"
    return train.df.sparkSession.createDataFrame(rows, schema)


def regularization_path(
    train: TabularDataset,
    test: TabularDataset,
    alphas: Iterable[float],
    make=Lasso,
) -> DataFrame:
    """``alpha, test_r2, intercept, coefficients`` for every alpha; a repeated one is an error."""
    alphas = [float(a) for a in alphas]
    if len(set(alphas)) < len(alphas):
        raise ValueError("an alpha is given twice")
    by_name = {repr(a): make(alpha=a) for a in alphas}
    table = compare_models(train, test, by_name)
    return table.select(
        F.col("model").cast("double").alias("alpha"), "test_r2", "intercept", "coefficients"
    )


class ScaledRegression:
    """Standardise, then fit a linear model, from one Gram scan.

    The moments of standardised features are an affine function of the raw
    ones, so scaling adds no scan. The result is a scaler and a model in
    scaled units.
    """

    def __init__(self, estimator: _LinearEstimator):
        self.estimator = estimator

    def fit(self, ds: TabularDataset):
        from gramspan.operators.scaler import StandardScaler

        m = moments(ds.df, ds.features, ds.label)
        scaler = StandardScaler().from_moments(ds.features, m)
        scaled = m.scaled(np.append(scaler.means, 0.0), np.append(scaler.stds, 1.0))
        return scaler, self.estimator.from_moments(ds.features, scaled)


def coefficients_table(spark, models: Sequence[tuple[str, LinearModel]]) -> DataFrame:
    rows = [
        (name, term, float(value))
        for name, m in models
        for term, value in zip(m.features.labels(), m.coefficients, strict=True)
    ]
    return spark.createDataFrame(rows, "model string, term string, value double")
