"""Two-class soft-margin support vector classification.

All solvers aim at the same optimum, ``|w|^2 / 2 + C * sum(hinge)``:

* a cascade of dual problems on the executors, see ``cascade``: exact to the
  tolerance for any kernel. Work grows with the number of support vectors;
* beyond ``WORKING_SET`` distinct rows, for a linear kernel or a polynomial one whose
  explicit feature map is small: MLlib's primal solver, a fixed number of
  aggregates whatever the row count;
* ``approximation='nystrom'`` replaces the kernel by its projection on a fixed
  number of landmark rows and is approximate. It is never chosen by itself.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramspan.functions import linear
from gramspan.operators.cascade import Cascade, Kernel, against_all, violations, worst_rows
from gramspan.operators.metrics import classification_metrics
from gramspan.session import RollingTable, durable
from gramspan.sources import Features, TabularDataset

KERNELS = ("linear", "polynomial", "rbf", "sigmoid")
# Rows of a dual problem that is solved at once: its kernel block takes at most 32 MB.
WORKING_SET = 2048
# Terms of an explicit polynomial feature map.
MAP_TERMS = 500
# Support vectors applied per pass when they are too many for one closure.
SUPPORT_CHUNK = 20_000


def _map_powers(kernel: Kernel, d: int) -> list[tuple[int, ...]] | None:
    """Exponents of the explicit map of a polynomial kernel, if small."""
    if kernel.name != "polynomial" or kernel.coef0 < 0:
        return None
    p = kernel.degree
    if math.comb(d + p, p) > MAP_TERMS:
        return None
    low = 0 if kernel.coef0 > 0 else p
    powers = []
    for total in range(low, p + 1):
        for pick in itertools.combinations_with_replacement(range(d), total):
            powers.append(tuple(pick.count(j) for j in range(d)))
    return powers


def _map_scale(kernel: Kernel, power: tuple[int, ...]) -> float:
    rest = kernel.degree - sum(power)
    ways = math.factorial(kernel.degree) / math.factorial(rest)
    for q in power:
        ways /= math.factorial(q)
    return math.sqrt(ways * kernel.gamma ** sum(power) * kernel.coef0**rest)


def _map_columns(kernel: Kernel, powers, x: list[Column]) -> list[Column]:
    """The explicit map as native expressions."""
    out = []
    for power in powers:
        term = F.lit(_map_scale(kernel, power))
        for c, q in zip(x, power, strict=True):
            for _ in range(q):
                term = term * c
        out.append(term)
    return out


@dataclass(frozen=True)
class SVCModel:
    """Score ``weights . map(x) + intercept`` or ``sum(dual * k(x, s)) + b``."""

    features: Features
    kernel: Kernel
    intercept: float
    n_iter: int
    tolerance: float
    weights: np.ndarray | None = None
    powers: tuple | None = None
    vectors: np.ndarray | None = None
    dual: np.ndarray | None = None
    # More support vectors than one closure should carry: kept as a table.
    support: DataFrame | None = field(default=None, repr=False)

    def decision_function(self, df: DataFrame, output: str = "score") -> DataFrame:
        self.features.check(df)
        if self.weights is not None:
            if self.powers is not None:
                x = [F.get(self.features.vector(), j) for j in range(self.features.width)]
                x = _map_columns(self.kernel, self.powers, x)
            else:
                x = self.features.operand()
            return df.withColumn(output, linear(x, self.weights, self.intercept))
        if self.support is None:
            score = _kernel_score(self.kernel, self.vectors, self.dual, self.features.width)
            return df.withColumn(output, score(self.features.vector()) + F.lit(self.intercept))
        return self._chunked_score(df, output)

    def _chunked_score(self, df: DataFrame, output: str) -> DataFrame:
        """Add the score one bounded chunk of support vectors at a time."""
        chunks = self.support.agg(F.max("chunk")).head()[0] + 1
        out = df.withColumn(output, F.lit(self.intercept))
        for c in range(chunks):
            part = self.support.filter(F.col("chunk") == c).collect()
            vectors = np.array([r["x"] for r in part], dtype=float)
            dual = np.array([r["dual"] for r in part])
            score = _kernel_score(self.kernel, vectors, dual, self.features.width)
            # Written out each time, so no plan ever holds two chunks.
            out = durable(out.withColumn(output, F.col(output) + score(self.features.vector())))
        return out

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Label +1 from a score of 0 on, else -1."""
        scored = self.decision_function(df, "_score")
        label = F.when(~F.isnan("_score") & (F.col("_score") >= 0.0), F.lit(1.0)).otherwise(F.lit(-1.0))
        return scored.withColumn(output, label).drop("_score")

    transform = predict

    def score(self, ds: TabularDataset) -> float:
        return classification_metrics(self.predict(ds.df), ds.label, "prediction").head()["accuracy"]

    def support_vectors(self, ds: TabularDataset) -> DataFrame:
        """Training rows on or inside the margin: ``y * score <= 1 + tol``."""
        scored = self.decision_function(ds.df)
        margin = F.col(ds.label).cast("double") * F.col("score")
        return scored.filter(margin <= 1.0 + self.tolerance)

    def n_support_vectors(self, ds: TabularDataset) -> int:
        return self.support_vectors(ds).count()


def _kernel_score(kernel: Kernel, vectors: np.ndarray, dual: np.ndarray, width: int):
    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        rows = np.stack(x.to_numpy()).astype(float).reshape(-1, width)
        return pd.Series(kernel.block(rows, vectors) @ dual)

    return score


class SVC:
    def __init__(
        self,
        c: float = 1.0,
        kernel: str = "rbf",
        gamma: float = 1.0,
        degree: int = 3,
        coef0: float = 0.0,
        tolerance: float = 1e-3,
        max_iter: int | None = None,
        approximation: str | None = None,
        landmarks: int = 500,
    ):
        if not c > 0:
            raise ValueError(f"penalty C = {c} is not above 0")
        if not gamma > 0:
            raise ValueError(f"kernel width gamma = {gamma} is not above 0")
        if kernel not in KERNELS:
            raise ValueError(f"kernel must be one of {KERNELS}")
        if degree < 0:
            raise ValueError("degree must not be negative")
        if approximation not in (None, "nystrom"):
            raise ValueError("approximation must be None or 'nystrom'")
        self.c, self.kernel = float(c), Kernel(kernel, float(gamma), degree, float(coef0))
        self.tolerance, self.max_iter = tolerance, 1000 if max_iter is None else max_iter
        self.approximation, self.landmarks = approximation, landmarks

    def fit(self, ds: TabularDataset) -> SVCModel:
        if ds.label is None:
            raise ValueError("a label column is needed")
        rows = ds.df.select(
            ds.features.vector().alias("x"), F.col(ds.label).cast("double").alias("y")
        )
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n, distinct = self._validate(rows)
            return self._fit(rows, ds.features, n, distinct)
        finally:
            rows.unpersist()

    def _validate(self, rows: DataFrame) -> tuple[int, int]:
        mark = F.round(F.col("y") * 1000.0)
        missing = F.col("x").isNull() | F.col("y").isNull() | F.exists("x", lambda v: v.isNull())
        r = rows.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(missing).alias("nulls"),
            F.count_if(mark == 1000.0).alias("pos"),
            F.count_if(mark == -1000.0).alias("neg"),
            F.approx_count_distinct(F.xxhash64("x"), 0.02).alias("distinct"),
        ).head()
        if r["n"] == 0:
            raise ValueError("input must have at least one sample")
        if r["nulls"]:
            raise ValueError("null in a feature or label column")
        if r["pos"] + r["neg"] != r["n"] or not r["pos"] or not r["neg"]:
            raise ValueError("SVC needs exactly the labels -1 and +1, both present")
        return r["n"], r["distinct"]

    def _fit(self, rows, features, n, distinct):
        sign = F.signum("y").alias("y")
        if distinct <= n // 2:
            # Copies of a row act as one row with a larger bound on its weight.
            merged = rows.groupBy("x", sign).agg(F.count(F.lit(1)).alias("w"))
        else:
            merged = rows.select("x", sign, F.lit(1).cast("long").alias("w"))
        if self.approximation == "nystrom" and self.kernel.name != "linear":
            return self._fit_nystrom(rows, features, n)
        if distinct > WORKING_SET:
            powers = _map_powers(self.kernel, features.width)
            if self.kernel.name == "linear":
                weights, bias, steps = self._fit_primal(rows.select("x", sign), F.col("x"), n)
                return SVCModel(features, self.kernel, bias, steps, self.tolerance, weights=weights)
            if powers is not None:
                x = [F.get("x", j) for j in range(features.width)]
                mapped = F.array(*_map_columns(self.kernel, powers, x))
                weights, bias, steps = self._fit_primal(rows.select("x", sign), mapped, n)
                return SVCModel(
                    features, self.kernel, bias, steps, self.tolerance, weights=weights, powers=tuple(powers)
                )
        return self._fit_cascade(merged, features, min(distinct, n))

    # --- solvers ------------------------------------------------------------

    def _fit_primal(self, rows: DataFrame, mapped: Column, n: int):
        from pyspark.ml.classification import LinearSVC
        from pyspark.ml.functions import array_to_vector

        data = rows.select(
            array_to_vector(mapped).alias("features"),
            F.when(F.col("y") > 0, 1.0).otherwise(0.0).alias("label"),
        )
        model = LinearSVC(
            regParam=1.0 / (n * self.c),
            standardization=False,
            maxIter=self.max_iter,
            tol=min(self.tolerance, 1e-3) * 1e-3,
        ).fit(data)
        return model.coefficients.toArray(), float(model.intercept), model.summary().totalIterations

    def _fit_nystrom(self, rows, features, n):
        m = min(self.landmarks, n)
        # A reproducible choice: the rows with the lowest hash.
        marks = rows.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(m).collect()
        points = np.array([r["x"] for r in marks], dtype=float).reshape(len(marks), -1)
        values, vectors = np.linalg.eigh(self.kernel.block(points, points))
        keep = values > max(values[-1], 0.0) * 1e-10
        half = vectors[:, keep] / np.sqrt(values[keep])
        kernel, width = self.kernel, features.width

        @F.pandas_udf("array<double>")
        def project(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            block = np.stack(x.to_numpy()).astype(float).reshape(-1, width)
            return pd.Series(list(kernel.block(block, points) @ half))

        linear_svc = SVC(self.c, "linear", tolerance=self.tolerance, max_iter=self.max_iter)
        mapped = rows.select(project("x").alias("z"), "y")
        model = linear_svc.fit(TabularDataset(mapped, Features(("z",), int(keep.sum()), True), "y"))
        return SVCModel(
            features,
            kernel,
            model.intercept,
            model.n_iter,
            self.tolerance,
            vectors=points,
            dual=half @ model.weights,
        )

    def _fit_cascade(self, merged, features, distinct):
        width, spark = features.width, merged.sparkSession
        most = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        leaves = min(-(-distinct // WORKING_SET), most)
        # Dealt out by hash, so that every leaf sees a fair share of both classes.
        dealt = merged.repartition(leaves, F.xxhash64("x"))
        state = durable(
            dealt.select(
                F.monotonically_increasing_id().alias("id"), "x", "y", (F.col("w") * F.lit(self.c)).alias("cap")
            )
        )
        cascade = Cascade(self.kernel, self.tolerance, self.max_iter, WORKING_SET)
        support, rounds = cascade.root(state, leaves, width), 0
        if leaves == 1:
            # The root has seen every row.
            top, bottom = support.filter("id is null").select("y", "cap").head()
        else:
            table = RollingTable(spark)
            for rounds in range(1, self.max_iter + 1):
                scored = against_all(table, state, support, self.kernel, width, SUPPORT_CHUNK)
                scored, top, bottom = violations(scored)
                if top - bottom <= self.tolerance:
                    break
                worst = worst_rows(scored, (top + bottom) / 2.0, self.tolerance, 2 * WORKING_SET)
                support = cascade.again(support, worst, width)
            table.close()
        support = support.filter("id is not null")
        n_support = support.count()
        if n_support == 0:
            raise ValueError("no support vectors found")
        model = SVCModel(features, self.kernel, (top + bottom) / 2.0, rounds, self.tolerance)
        if self.kernel.name == "linear":
            sums = support.agg(*[F.sum(F.col("u") * F.get("x", j)).alias(f"w{j}") for j in range(width)])
            return replace(model, weights=np.array(sums.head(), dtype=float))
        if n_support <= SUPPORT_CHUNK:
            local = support.select("x", "u").collect()
            return replace(
                model,
                vectors=np.array([r["x"] for r in local], dtype=float).reshape(n_support, -1),
                dual=np.array([r["u"] for r in local]),
            )
        chunks = -(-n_support // SUPPORT_CHUNK) * 2
        chunk = F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk")
        return replace(model, support=durable(support.select("x", F.col("u").alias("dual"), chunk)))


def svc_sweep(train: TabularDataset, test: TabularDataset, models: Iterable[tuple[str, SVC]]) -> DataFrame:
    """``model, train_accuracy, test_accuracy, n_support`` per setting."""
    # Only what the fits read is held; both sides may be the same frame.
    slim = [d.with_df(d.df.select(*d.features.names, d.label)) for d in (train, test)]
    held = [d.df.persist(StorageLevel.MEMORY_AND_DISK) for d in slim]
    train, test = slim
    rows = []
    try:
        for name, svc in models:
            m = svc.fit(train)
            rows.append((name, m.score(train), m.score(test), m.n_support_vectors(train)))
    finally:
        for df in held:
            df.unpersist()
    return train.df.sparkSession.createDataFrame(
        rows, "model string, train_accuracy double, test_accuracy double, n_support long"
    )


def c_sweep(train, test, values: Sequence[float], **params) -> DataFrame:
    return svc_sweep(train, test, [(f"C={c:g}", SVC(c=c, **params)) for c in values])


def kernel_sweep(train, test, kernels: Sequence[str] = KERNELS, **params) -> DataFrame:
    return svc_sweep(train, test, [(k, SVC(kernel=k, **params)) for k in kernels])
