"""Regression and classification metrics over two columns of one DataFrame.

All of a family's metrics come from one aggregate; each public function picks
its number from it. Rows are paired by construction, so lengths always agree;
``pair`` makes one DataFrame of labels and predictions that live in two.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramspan.functions import clip


def _col(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _whole(n: Column, nulls: Column) -> Column:
    """The row count; an error if a pair was incomplete, as fits have it."""
    return F.when(nulls > 0, F.raise_error(F.lit("null label or prediction")).cast("long")).otherwise(n)


def pair(truth: DataFrame, predicted: DataFrame, key: str | Sequence[str], label: str, prediction: str) -> DataFrame:
    """The key columns with ``y_true`` and ``y_pred``, paired one to one by key.

    A key that is null in part, missing on a side or repeated on one stops the query that
    reads either value. It is found by the shuffle that brings the pairs together:
    rows of both sides are counted per key, which is pre-aggregated, so that not
    even a key with very many rows gathers them in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = truth.select(*keys, _col(label).alias("t"), F.lit(1).alias("of_t"), F.lit(None).cast("double").alias("p"))
    other = predicted.select(*keys, F.lit(None).cast("double").alias("t"), F.lit(0).alias("of_t"), _col(prediction).alias("p"))
    held = rows.unionByName(other).toDF(*[f"k{i}" for i in range(len(keys))], "t", "of_t", "p")
    named = [f"k{i}" for i in range(len(keys))]
    both = held.groupBy(*named).agg(
        F.sum("of_t").alias("n_t"), F.sum(1 - F.col("of_t")).alias("n_p"), F.max("t").alias("t"), F.max("p").alias("p")
    )
    broken = F.lit(False)
    for k in named:
        broken = broken | F.col(k).isNull()
    text = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in named])
    problem = (
        F.when(broken, F.lit("a key is null"))
        .when(F.col("n_t") == 0, F.lit("a prediction has no label"))
        .when(F.col("n_p") == 0, F.lit("a label has no prediction"))
        .when((F.col("n_t") > 1) | (F.col("n_p") > 1), F.lit("a key is repeated"))
    )
    stop = F.raise_error(F.concat(problem, F.lit(": "), text)).cast("double")
    checked = [F.when(problem.isNotNull(), stop).otherwise(F.col(c)).alias(n) for c, n in (("t", "y_true"), ("p", "y_pred"))]
    return both.select(*[F.col(k).alias(n) for k, n in zip(named, keys, strict=True)], *checked)


def regression_metrics(df: DataFrame, y_true, y_pred) -> DataFrame:
    """One row ``n, mse, mae, r2`` in a single pass.

    The total sum of squares comes from the running population variance, which
    is stable without a separate pass for the mean. A null is an error.
    """
    t, p = _col(y_true), _col(y_pred)
    sums = df.select(t.alias("t"), p.alias("p")).agg(
        _whole(F.count(F.lit(1)), F.count_if(F.col("t").isNull() | F.col("p").isNull())).alias("n"),
        F.avg((F.col("t") - F.col("p")) * (F.col("t") - F.col("p"))).alias("mse"),
        F.avg(F.abs(F.col("t") - F.col("p"))).alias("mae"),
        F.var_pop("t").alias("var"),
    )
    r2 = F.when(F.col("var") == 0.0, F.lit(1.0)).otherwise(
        F.lit(1.0) - F.col("mse") / F.when(F.col("var") != 0.0, F.col("var"))
    )
    return sums.select("n", "mse", "mae", r2.alias("r2"))


def _positive(c: Column) -> Column:
    # Spark ranks NaN above every number, so it must be excluded explicitly.
    return ~F.isnan(c) & (c > 0.5)


def classification_metrics(df: DataFrame, y_true, y_pred) -> DataFrame:
    """One row ``n, tn, fp, fn, tp, accuracy, precision, recall, f1``.

    A value above 0.5 is positive and everything else negative, so 0/1 and
    -1/+1 labels both work. Accuracy compares the values themselves. A null is
    an error.
    """
    pairs = df.select(_col(y_true).alias("t"), _col(y_pred).alias("p"))
    t, p = _positive(F.col("t")), _positive(F.col("p"))
    counts = pairs.agg(
        _whole(F.count(F.lit(1)), F.count_if(F.col("t").isNull() | F.col("p").isNull())).alias("n"),
        F.count_if(~t & ~p).alias("tn"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(t & p).alias("tp"),
        F.count_if(F.abs(F.col("t") - F.col("p")) < 1e-10).alias("hits"),
    )

    def ratio(num: Column, den: Column, empty: float) -> Column:
        return F.when(den == 0, F.lit(empty)).otherwise(num / F.when(den != 0, den))

    c = F.col
    with_ratios = counts.select(
        "n",
        "tn",
        "fp",
        "fn",
        "tp",
        ratio(c("hits"), c("n"), float("nan")).alias("accuracy"),
        ratio(c("tp"), c("tp") + c("fp"), 0.0).alias("precision"),
        ratio(c("tp"), c("tp") + c("fn"), 0.0).alias("recall"),
    )
    both = c("precision") + c("recall")
    return with_ratios.withColumn("f1", ratio(c("precision") * c("recall") * 2.0, both, 0.0))


def confusion_counts(df: DataFrame, y_true, y_pred) -> DataFrame:
    """Long form ``actual, predicted, count`` with all four cells present."""
    m = classification_metrics(df, y_true, y_pred)
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    grid = F.array(
        *[
            F.struct(
                F.lit(float(a)).alias("actual"), F.lit(float(b)).alias("predicted"), F.col(k).alias("count")
            )
            for a, b, k in cells
        ]
    )
    # With the count, so that pruning cannot drop its check for nulls.
    return m.filter("n >= 0").select(F.inline(grid))


def log_loss_term(y: Column, p: Column) -> Column:
    """Loss of one row; the probability is clipped to 1e-15 from 0 and 1."""
    q = clip(p, 1e-15, 1.0 - 1e-15)
    return -y * F.log(q) - (1.0 - y) * F.log(1.0 - q)


def log_loss_metric(df: DataFrame, y_true, p) -> DataFrame:
    """One row ``log_loss``. A null is an error."""
    pairs = df.select(_col(y_true).alias("t"), _col(p).alias("p"))
    none = F.count_if(F.col("t").isNull() | F.col("p").isNull())
    wrong = F.raise_error(F.lit("null label or probability")).cast("double")
    return pairs.agg(F.when(none > 0, wrong).otherwise(F.avg(log_loss_term(F.col("t"), F.col("p")))).alias("log_loss"))


def _regression(df, y_true, y_pred, name) -> float:
    r = regression_metrics(df, y_true, y_pred).head()
    if r["n"] == 0:
        raise ValueError("metrics need at least one row")
    return r[name]


def mean_squared_error(df: DataFrame, y_true, y_pred) -> float:
    return _regression(df, y_true, y_pred, "mse")


def mean_absolute_error(df: DataFrame, y_true, y_pred) -> float:
    return _regression(df, y_true, y_pred, "mae")


def r2_score(df: DataFrame, y_true, y_pred) -> float:
    return _regression(df, y_true, y_pred, "r2")


def _classification(df, y_true, y_pred, name) -> float:
    # The whole row: a column alone would not carry the check for nulls.
    return classification_metrics(df, y_true, y_pred).head()[name]


def accuracy_score(df: DataFrame, y_true, y_pred) -> float:
    return _classification(df, y_true, y_pred, "accuracy")


def precision_score(df: DataFrame, y_true, y_pred) -> float:
    return _classification(df, y_true, y_pred, "precision")


def recall_score(df: DataFrame, y_true, y_pred) -> float:
    return _classification(df, y_true, y_pred, "recall")


def f1_score(df: DataFrame, y_true, y_pred) -> float:
    return _classification(df, y_true, y_pred, "f1")


def confusion_matrix(df: DataFrame, y_true, y_pred) -> np.ndarray:
    r = classification_metrics(df, y_true, y_pred).head()
    return np.array([[r["tn"], r["fp"]], [r["fn"], r["tp"]]], dtype=float)


def log_loss(df: DataFrame, y_true, p) -> float:
    value = log_loss_metric(df, y_true, p).head()["log_loss"]
    if value is None:
        raise ValueError("metrics need at least one row")
    return value
