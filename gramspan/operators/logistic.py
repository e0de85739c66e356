"""Binary logistic regression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramspan.functions import linear, sigmoid
from gramspan.operators.metrics import classification_metrics, log_loss, log_loss_term
from gramspan.plans.gram import arrow_matrix
from gramspan.sources import Features, TabularDataset

# Numbers of merged rows that one task holds for the whole descent: 256 MB.
TASK_CELLS = 32_000_000
_CLIP = 1e-15


@dataclass(frozen=True)
class LogisticModel:
    features: Features
    coefficients: np.ndarray
    intercept: float
    n_iter: int

    def _probability(self):
        return sigmoid(linear(self.features.operand(), self.coefficients, self.intercept))

    def predict_proba(self, df: DataFrame, output: str = "probability") -> DataFrame:
        self.features.check(df)
        return df.withColumn(output, self._probability())

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Label 1 from a probability of 0.5 on."""
        self.features.check(df)
        p = self._probability()
        return df.withColumn(
            output, F.when(~F.isnan(p) & (p >= 0.5), F.lit(1.0)).otherwise(F.lit(0.0))
        )

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` and ``prediction``."""
        return self.predict(self.predict_proba(df))

    def score(self, ds: TabularDataset) -> float:
        return classification_metrics(self.predict(ds.df), ds.label, "prediction").head()["accuracy"]

    def loss(self, ds: TabularDataset) -> float:
        return log_loss(self.predict_proba(ds.df), ds.label, "probability")

    def evaluate(self, ds: TabularDataset) -> DataFrame:
        """One row ``n, accuracy, log_loss``, in one pass."""
        scored, y = self.transform(ds.df), F.col(ds.label).cast("double")
        hit = F.abs(F.col("prediction") - y) < 1e-10
        return scored.agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("accuracy"),
            F.avg(log_loss_term(y, F.col("probability"))).alias("log_loss"),
        )

    def params(self, spark) -> DataFrame:
        rows = [("intercept", float(self.intercept))]
        rows += list(zip(self.features.labels(), map(float, self.coefficients), strict=True))
        return spark.createDataFrame(rows, "term string, value double")


class LogisticRegression:
    """Unregularised, by full-batch gradient descent from zero.

    ``solver='gd'`` returns the iterate at the stopping rule, which is the
    contract for small learning rates. Equal feature vectors are merged into
    one weighted row first. Merged rows that fit into a task's memory are read
    once, by one task that takes all steps; more rows take one aggregate per step.
    (Tasks of a barrier stage could exchange their sums instead, but an exchange
    takes most of a second, more than an aggregate.)
    ``solver='mle'`` returns the maximum-likelihood fit (MLlib) instead, in a
    few dozen passes.
    """

    def __init__(
        self,
        learning_rate: float = 0.01,
        max_iterations: int = 1000,
        fit_intercept: bool = True,
        tolerance: float = 1e-6,
        solver: str = "gd",
    ):
        if solver not in ("gd", "mle"):
            raise ValueError("solver must be 'gd' or 'mle'")
        self.learning_rate, self.max_iterations = learning_rate, max_iterations
        self.fit_intercept, self.tolerance, self.solver = fit_intercept, tolerance, solver

    def fit(self, ds: TabularDataset) -> LogisticModel:
        if ds.label is None:
            raise ValueError("a label column is needed")
        rows = ds.df.select(
            ds.features.vector().alias("x"), F.col(ds.label).cast("double").alias("y")
        )
        missing = F.col("x").isNull() | F.col("y").isNull() | F.exists("x", lambda v: v.isNull())
        seen = rows.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(missing).alias("nulls"),
            F.count_if(~F.col("y").isin(0.0, 1.0)).alias("bad"),
            F.approx_count_distinct(F.xxhash64("x"), 0.02).alias("distinct"),
        ).head()
        if seen["nulls"]:
            raise ValueError("null in a feature or label column")
        if seen["n"] == 0:
            raise ValueError("input must have at least one sample")
        if seen["bad"]:
            raise ValueError("found a label other than 0 and 1")
        if self.solver == "mle":
            return self._fit_mle(rows, ds.features)
        return self._fit_gd(rows, ds.features, seen["n"], seen["distinct"])

    def _fit_gd(self, rows, features, n, distinct):
        weighted = (
            rows.groupBy("x").agg(F.count(F.lit(1)).alias("w"), F.sum("y").alias("pos"))
            if distinct <= n // 2
            else rows.select("x", F.lit(1).cast("long").alias("w"), F.col("y").alias("pos"))
        )
        weighted = weighted.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            m = weighted.count()
            if m * (features.width + 2) <= TASK_CELLS:
                theta, steps = self._descent_in_task(weighted, features.width, n)
            else:
                theta, steps = self._job_per_step(weighted, features.width, n)
        finally:
            weighted.unpersist()
        return LogisticModel(features, theta[1:], float(theta[0]), steps)

    def _job_per_step(self, weighted, width, n):
        try:
            return self._descend(lambda theta: _distributed_step(weighted, theta, width), width, n)
        except FloatingPointError as e:
            raise ValueError(str(e)) from e

    def _descent_in_task(self, weighted, width, n):
        def run(batches):
            none = np.zeros(0)
            parts = [(none.reshape(0, width), none, none)]
            for b in batches:
                parts.append((arrow_matrix(b.column(0), width)[0], *(b.column(c).to_numpy() for c in (1, 2))))
            x, w, pos = (np.concatenate(c) for c in zip(*parts, strict=True))
            try:
                theta, steps = self._descend(lambda v: _loss_and_gradient(x, w, pos, v), width, n)
            except FloatingPointError:
                theta, steps = np.full(width + 1, np.nan), 0
            yield pa.RecordBatch.from_pydict(
                {"theta": pa.array([theta], pa.list_(pa.float64())), "steps": pa.array([steps], pa.int32())}
            )

        rows = weighted.select("x", F.col("w").cast("double"), F.col("pos").cast("double")).repartition(1)
        found = rows.mapInArrow(run, "theta array<double>, steps int").head()
        theta = np.array(found["theta"], dtype=float)
        if np.isnan(theta).any():
            raise ValueError("gradient descent diverged")
        return theta, found["steps"]

    def _descend(self, evaluate, width, n):
        theta = np.zeros(width + 1)
        previous, calm = np.inf, 0
        for step in range(self.max_iterations):
            loss, gradient = evaluate(theta)
            loss /= n
            if not np.isfinite(loss):
                raise FloatingPointError("gradient descent diverged")
            calm = calm + 1 if abs(previous - loss) < self.tolerance else 0
            if calm > 10:
                return theta, step
            if not self.fit_intercept:
                gradient[0] = 0.0
            theta = theta - gradient / n * self.learning_rate
            previous = loss
        return theta, self.max_iterations

    def _fit_mle(self, rows, features):
        from pyspark.ml.classification import LogisticRegression as MLLogistic
        from pyspark.ml.functions import array_to_vector

        model = MLLogistic(
            regParam=0.0,
            standardization=False,
            fitIntercept=self.fit_intercept,
            maxIter=self.max_iterations,
            tol=1e-9,
            labelCol="y",
            featuresCol="v",
        ).fit(rows.select(array_to_vector("x").alias("v"), "y"))
        return LogisticModel(
            features,
            model.coefficients.toArray(),
            float(model.intercept),
            model.summary.totalIterations,
        )


def _loss_and_gradient(x, w, pos, theta):
    """Summed loss and gradient (intercept first) of weighted rows."""
    z = x @ theta[1:] + theta[0]
    p = 1.0 / (1.0 + np.exp(-np.clip(z, -500.0, 500.0)))
    p = np.where(z > 500.0, 1.0, np.where(z < -500.0, 0.0, p))
    q = np.clip(p, _CLIP, 1.0 - _CLIP)
    loss = -(pos * np.log(q) + (w - pos) * np.log(1.0 - q)).sum()
    error = w * p - pos
    return float(loss), np.concatenate([[error.sum()], x.T @ error])


def _distributed_step(weighted: DataFrame, theta: np.ndarray, width: int):
    def run(batches):
        loss, gradient = 0.0, np.zeros(width + 1)
        for batch in batches:
            x, _ = arrow_matrix(batch.column("x"), width)
            w = batch.column("w").to_numpy(zero_copy_only=False).astype(float)
            pos = batch.column("pos").to_numpy(zero_copy_only=False).astype(float)
            part, grad = _loss_and_gradient(x, w, pos, theta)
            loss, gradient = loss + part, gradient + grad
        yield pa.RecordBatch.from_pydict(
            {"loss": pa.array([loss]), "g": pa.array([gradient], type=pa.list_(pa.float64()))}
        )

    parts = weighted.select("x", "w", "pos").mapInArrow(run, "loss double, g array<double>")
    r = parts.agg(
        F.sum("loss").alias("loss"), F.array(*[F.sum(F.get("g", j)) for j in range(width + 1)]).alias("g")
    ).head()
    return r["loss"], np.array(r["g"], dtype=float)
