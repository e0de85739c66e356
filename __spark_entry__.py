"""

Every query reads whole tables. Numbers are rounded on both sides, and 0.0 is
added so that a negative zero compares equal.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from gramspan import functions as V  # noqa: E402
from gramspan.operators import (  # noqa: E402
    DBSCAN,
    LDA,
    PCA,
    SVC,
    ElasticNet,
    KMeans,
    Lasso,
    LinearRegression,
    LogisticRegression,
    Ridge,
    ScaledRegression,
    StandardScaler,
    TruncatedSVD,
    c_sweep,
    compare_models,
    dbscan_sweep,
    kernel_sweep,
    kmeans_sweep,
    metrics,
    reconstruction_comparison,
    region_query,
    regularization_path,
)
from gramspan.plans.gram import grouped_moments, moments  # noqa: E402
from gramspan.plans.ordering import with_row_index  # noqa: E402
from gramspan.session import ensure_checkpoint_dir  # noqa: E402
from gramspan.sources import TabularDataset, read_csv, read_table  # noqa: E402
from gramspan.streaming.scoring import read_stream, score_available  # noqa: E402

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its oracle if any."""

    def register(fn):
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _ORACLES[fn.__name__] = sql
        return fn

    return register


def r(c: Column | str, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits) + F.lit(0.0)


def _scratch(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"


# --- inputs -----------------------------------------------------------------

LINEITEM_KEY = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_extendedprice",
)
_KEY_SQL = ", ".join(LINEITEM_KEY)


def _lineitem(spark, sf, features=("l_quantity", "l_discount", "l_tax")) -> TabularDataset:
    df = read_table(spark, sf, "lineitem")
    return TabularDataset(df, list(features), "l_extendedprice", LINEITEM_KEY)


# A target that depends on two features and carries the price as noise.
_SIGNAL_SQL = "3 * l_quantity + 200 * l_discount + l_extendedprice / 10000"


def _signal(spark, sf) -> TabularDataset:
    df = read_table(spark, sf, "lineitem").withColumn(
        "y",
        3 * F.col("l_quantity") + 200 * F.col("l_discount") + F.col("l_extendedprice") / 10000,
    )
    return TabularDataset(df, ["l_quantity", "l_discount"], "y", LINEITEM_KEY)


# Second-order statistics of (a, b, y) with y the signal; used by the oracles.
_STATS_SQL = f"""
base AS (SELECT l_quantity AS a, l_discount AS b, {_SIGNAL_SQL} AS y, {_KEY_SQL} FROM lineitem),
st AS (SELECT count(*)::DOUBLE AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my,
  covar_pop(a, a) AS caa, covar_pop(a, b) AS cab, covar_pop(b, b) AS cbb,
  covar_pop(a, y) AS cay, covar_pop(b, y) AS cby, covar_pop(y, y) AS cyy FROM base)"""


def _terms_sql(a: str, b: str, intercept: str, source: str, digits: int = 5) -> str:
    return f"""
SELECT term, round(value, {digits}) + 0.0 AS value FROM (
  SELECT 'intercept' AS term, {intercept} AS value FROM {source}
  UNION ALL SELECT 'l_quantity', {a} FROM {source}
  UNION ALL SELECT 'l_discount', {b} FROM {source}) t"""


def _params(model, spark, digits: int = 5) -> DataFrame:
    return model.params(spark).select("term", r("value", digits).alias("value"))


# --- data set, order, split, csv ---------------------------------------------


@query("SELECT count(*) AS n_samples, CAST(3 AS BIGINT) AS n_features FROM lineitem")
def dataset_shape(spark, sf):
    return _lineitem(spark, sf).shape()


def _split_sql(side: str) -> str:
    return f"""
WITH t AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS i,
    count(*) OVER () AS n FROM orders)
SELECT o_orderkey, o_totalprice FROM t WHERE i {side} n - CAST(floor(n * 0.3 + 0.5) AS BIGINT)"""


def _orders(spark, sf) -> TabularDataset:
    return TabularDataset(
        read_table(spark, sf, "orders"), ["o_totalprice"], order_by=["o_orderkey"]
    )


@query(_split_sql("<"))
def split_train(spark, sf):
    return _orders(spark, sf).train_test_split(0.3)[0].df.select("o_orderkey", "o_totalprice")


@query(_split_sql(">="))
def split_test(spark, sf):
    return _orders(spark, sf).train_test_split(0.3)[1].df.select("o_orderkey", "o_totalprice")


@query(
    f"""
WITH t AS (SELECT l_quantity, row_number() OVER (ORDER BY {_KEY_SQL}) - 1 AS i,
    count(*) OVER () AS n FROM lineitem)
SELECT CASE WHEN i < n - CAST(floor(n * 0.2 + 0.5) AS BIGINT) THEN 'train' ELSE 'test' END AS side,
  count(*) AS n, round(sum(l_quantity), 2) + 0.0 AS quantity FROM t GROUP BY 1"""
)
def split_composite_key(spark, sf):
    sides = _lineitem(spark, sf).train_test_split(0.2)
    out = [
        d.df.agg(F.count(F.lit(1)).alias("n"), r(F.sum("l_quantity"), 2).alias("quantity")).select(
            F.lit(name).alias("side"), "n", "quantity"
        )
        for name, d in zip(("train", "test"), sides, strict=True)
    ]
    return out[0].unionByName(out[1])


@query(
    f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice,
  row_number() OVER (ORDER BY {_KEY_SQL}) - 1 AS row_idx FROM lineitem"""
)
def row_index(spark, sf):
    keys = read_table(spark, sf, "lineitem").select(*LINEITEM_KEY)
    return with_row_index(keys, LINEITEM_KEY).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "row_idx"
    )


@query(
    """SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, CAST(c_nationkey AS DOUBLE) AS c_nationkey,
  c_acctbal FROM customer"""
)
def csv_roundtrip(spark, sf):
    folder = _scratch(spark)
    table = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    table.write.option("header", True).csv(folder)
    return read_csv(spark, folder).df


# --- scaling -----------------------------------------------------------------


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 6) + 0.0 AS mean,"
        f" round(stddev_pop({c}), 6) + 0.0 AS std FROM lineitem"
        for c in ("l_quantity", "l_discount", "l_tax")
    )
)
def scaler_params(spark, sf):
    params = StandardScaler().fit(_lineitem(spark, sf)).params(spark)
    return params.select("feature", r("mean").alias("mean"), r("std").alias("std"))


_SCALED_SQL = ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem), 6)"
    f" + 0.0 AS {c}"
    for c in ("l_quantity", "l_discount", "l_tax")
)


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, {_SCALED_SQL} FROM lineitem")
def scaler_transform(spark, sf):
    ds = StandardScaler().fit_transform(_lineitem(spark, sf))
    return ds.df.select(
        "l_orderkey", "l_linenumber", "l_partkey", *[r(c).alias(c) for c in ds.features.names]
    )


# --- metrics -----------------------------------------------------------------

_RESID_SQL = "(l_extendedprice - 1500 * l_quantity)"


def _regression(spark, sf) -> DataFrame:
    guess = F.col("l_quantity") * 1500
    return metrics.regression_metrics(read_table(spark, sf, "lineitem"), "l_extendedprice", guess)


@query(f"SELECT round(avg({_RESID_SQL} * {_RESID_SQL}), 2) + 0.0 AS mse FROM lineitem")
def mse(spark, sf):
    return _regression(spark, sf).select(r("mse", 2).alias("mse"))


@query(f"SELECT round(avg(abs{_RESID_SQL}), 4) + 0.0 AS mae FROM lineitem")
def mae(spark, sf):
    return _regression(spark, sf).select(r("mae", 4).alias("mae"))


@query(
    f"""SELECT round(1 - sum({_RESID_SQL} * {_RESID_SQL}) / (count(*) * var_pop(l_extendedprice)), 6)
  + 0.0 AS r2 FROM lineitem"""
)
def r2(spark, sf):
    return _regression(spark, sf).select(r("r2").alias("r2"))


@query(
    """WITH guess AS (SELECT l_partkey, avg(l_extendedprice / l_quantity) AS g FROM lineitem GROUP BY l_partkey),
d AS (SELECT p_retailprice AS t, g AS p FROM part JOIN guess ON p_partkey = l_partkey)
SELECT count(*) AS n, round(avg((t - p) * (t - p)), 4) + 0.0 AS mse, round(avg(abs(t - p)), 4) + 0.0 AS mae,
  round(1 - sum((t - p) * (t - p)) / (count(*) * var_pop(t)), 4) + 0.0 AS r2 FROM d"""
)
def paired_metrics(spark, sf):
    """Labels and predictions from two tables, paired one to one by key."""
    guess = read_table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"))
    guess = guess.agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("guess"))
    both = metrics.pair(read_table(spark, sf, "part"), guess, "p_partkey", "p_retailprice", "guess")
    found = metrics.regression_metrics(both, "y_true", "y_pred")
    return found.select("n", *[r(c, 4).alias(c) for c in ("mse", "mae", "r2")])


def _classification(spark, sf) -> DataFrame:
    df = read_table(spark, sf, "labels")
    return metrics.classification_metrics(df, "quality", 1 - F.col("toxic"))


_CELLS_SQL = """WITH c AS (SELECT count(*) AS n,
  count(*) FILTER (quality = 1 AND toxic = 0) AS tp, count(*) FILTER (quality = 0 AND toxic = 0) AS fp,
  count(*) FILTER (quality = 1 AND toxic = 1) AS fn, count(*) FILTER (quality = 0 AND toxic = 1) AS tn
  FROM labels)"""


@query(f"{_CELLS_SQL} SELECT round((tp + tn) / n, 6) + 0.0 AS accuracy FROM c")
def accuracy(spark, sf):
    return _classification(spark, sf).select(r("accuracy").alias("accuracy"))


@query(f"{_CELLS_SQL} SELECT round(tp / (tp + fp), 6) + 0.0 AS precision FROM c")
def precision(spark, sf):
    return _classification(spark, sf).select(r("precision").alias("precision"))


@query(f"{_CELLS_SQL} SELECT round(tp / (tp + fn), 6) + 0.0 AS recall FROM c")
def recall(spark, sf):
    return _classification(spark, sf).select(r("recall").alias("recall"))


@query(f"{_CELLS_SQL} SELECT round(2 * tp / (2 * tp + fp + fn), 6) + 0.0 AS f1 FROM c")
def f1(spark, sf):
    return _classification(spark, sf).select(r("f1").alias("f1"))


@query(
    f"""{_CELLS_SQL} SELECT 0.0::DOUBLE AS actual, 0.0::DOUBLE AS predicted, tn AS count FROM c
UNION ALL SELECT 0.0, 1.0, fp FROM c UNION ALL SELECT 1.0, 0.0, fn FROM c UNION ALL SELECT 1.0, 1.0, tp FROM c"""
)
def confusion(spark, sf):
    df = read_table(spark, sf, "labels")
    return metrics.confusion_counts(df, "quality", 1 - F.col("toxic"))


@query(
    """WITH p AS (SELECT quality AS y, greatest(least(1.02 - 0.9 * toxic - 0.1 / (1 + doc_id), 1 - 1e-15), 1e-15) AS p
  FROM labels)
SELECT round(avg(-y * ln(p) - (1 - y) * ln(1 - p)), 6) + 0.0 AS log_loss FROM p"""
)
def log_loss(spark, sf):
    df = read_table(spark, sf, "labels")
    p = 1.02 - 0.9 * F.col("toxic") - 0.1 / (1 + F.col("doc_id"))
    return metrics.log_loss_metric(df, "quality", p).select(r("log_loss").alias("log_loss"))


# --- linear models -----------------------------------------------------------


@query(
    """SELECT 'intercept' AS term, round(regr_intercept(l_extendedprice, l_quantity), 4) + 0.0 AS value FROM lineitem
UNION ALL SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 4) + 0.0 FROM lineitem"""
)
def ols_1d(spark, sf):
    return _params(LinearRegression().fit(_lineitem(spark, sf, ["l_quantity"])), spark, 4)


_OLS_SQL = f"""WITH {_STATS_SQL},
sol AS (SELECT *, (cay * cbb - cby * cab) / (caa * cbb - cab * cab) AS wa,
  (cby * caa - cay * cab) / (caa * cbb - cab * cab) AS wb FROM st)"""


@query(_OLS_SQL + _terms_sql("wa", "wb", "my - wa * ma - wb * mb", "sol"))
def ols_multi(spark, sf):
    return _params(LinearRegression().fit(_signal(spark, sf)), spark)


@query(
    f"""{_OLS_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, round(my + wa * (a - ma) + wb * (b - mb), 5) + 0.0 AS prediction
FROM base, sol"""
)
def ols_predict(spark, sf):
    ds = _signal(spark, sf)
    scored = LinearRegression().fit(ds).transform(ds.df)
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", r("prediction", 5).alias("prediction"))


@query(
    """SELECT count(*) AS n, round(avg(abs(p_retailprice - p)), 5) + 0.0 AS mae,
  round(1 - sum((p_retailprice - p) * (p_retailprice - p)) / (count(*) * var_pop(p_retailprice)), 6) + 0.0 AS r2
FROM (SELECT p_retailprice, (SELECT regr_intercept(p_retailprice, p_partkey) FROM part)
  + (SELECT regr_slope(p_retailprice, p_partkey) FROM part) * p_partkey AS p FROM part) t"""
)
def ols_score(spark, sf):
    ds = TabularDataset(read_table(spark, sf, "part"), ["p_partkey"], "p_retailprice")
    return LinearRegression().fit(ds).evaluate(ds).select(
        "n", r("mae", 5).alias("mae"), r("r2").alias("r2")
    )


@query(
    f"""WITH {_STATS_SQL},
g AS (SELECT caa + ma * ma AS gaa, cab + ma * mb AS gab, cbb + mb * mb AS gbb,
  cay + ma * my AS ga, cby + mb * my AS gb FROM st),
sol AS (SELECT (ga * gbb - gb * gab) / (gaa * gbb - gab * gab) AS wa,
  (gb * gaa - ga * gab) / (gaa * gbb - gab * gab) AS wb FROM g)"""
    + _terms_sql("wa", "wb", "0.0", "sol")
)
def ols_no_intercept(spark, sf):
    return _params(LinearRegression(fit_intercept=False).fit(_signal(spark, sf)), spark)


@query(
    """WITH s AS (SELECT regr_slope(l_extendedprice, l_quantity) AS w,
  regr_intercept(l_extendedprice, l_quantity) AS c FROM lineitem)
SELECT 'intercept' AS term, round(c, 4) + 0.0 AS value FROM s
UNION ALL SELECT 'l_quantity', round(w / 5, 4) + 0.0 FROM s
UNION ALL SELECT 'twice', round(2 * w / 5, 4) + 0.0 FROM s"""
)
def ols_collinear(spark, sf):
    """One column is twice the other: the solution of least norm."""
    df = read_table(spark, sf, "lineitem").withColumn("twice", 2 * F.col("l_quantity"))
    ds = TabularDataset(df, ["l_quantity", "twice"], "l_extendedprice")
    return _params(LinearRegression().fit(ds), spark, 4)


@query(
    f"""WITH {_STATS_SQL},
t AS (SELECT *, row_number() OVER (ORDER BY {_KEY_SQL}) - 1 AS i, count(*) OVER () AS m FROM base),
s AS (SELECT *, i < m - CAST(floor(m * 0.2 + 0.5) AS BIGINT) AS train FROM t),
f AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, covar_pop(a, a) AS caa, covar_pop(a, b) AS cab,
  covar_pop(b, b) AS cbb, covar_pop(a, y) AS cay, covar_pop(b, y) AS cby FROM s WHERE train),
w AS (SELECT *, (cay * cbb - cby * cab) / (caa * cbb - cab * cab) AS wa,
  (cby * caa - cay * cab) / (caa * cbb - cab * cab) AS wb FROM f),
p AS (SELECT y, my + wa * (a - ma) + wb * (b - mb) AS p FROM s, w WHERE NOT train)
SELECT count(*) AS n, round(avg((y - p) * (y - p)), 6) + 0.0 AS mse, round(avg(abs(y - p)), 6) + 0.0 AS mae,
  round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 6) + 0.0 AS r2 FROM p"""
)
def split_scale_fit_score(spark, sf):
    """Split, standardise on the training side, fit, evaluate on the test side."""
    train, test = _signal(spark, sf).train_test_split(0.2)
    scaler, model = ScaledRegression(LinearRegression()).fit(train)
    return model.evaluate(scaler.transform(test)).select(
        "n", *[r(c).alias(c) for c in ("mse", "mae", "r2")]
    )


def _ridge_sql(caa: str, cab: str, cbb: str, cay: str, cby: str, alpha: float) -> str:
    a, c = f"(n * {caa} + {alpha})", f"(n * {cbb} + {alpha})"
    b, u, v = f"(n * {cab})", f"(n * {cay})", f"(n * {cby})"
    return f"""({u} * {c} - {v} * {b}) / ({a} * {c} - {b} * {b}) AS wa,
  ({v} * {a} - {u} * {b}) / ({a} * {c} - {b} * {b}) AS wb"""


@query(
    f"WITH {_STATS_SQL}, sol AS (SELECT *, {_ridge_sql('caa', 'cab', 'cbb', 'cay', 'cby', 50.0)} FROM st)"
    + _terms_sql("wa", "wb", "my - wa * ma - wb * mb", "sol")
)
def ridge(spark, sf):
    return _params(Ridge(alpha=50.0).fit(_signal(spark, sf)), spark)


@query(
    f"""WITH {_STATS_SQL},
z AS (SELECT *, sqrt(caa) AS sa, sqrt(cbb) AS sb FROM st),
u AS (SELECT *, {_ridge_sql("1.0", "cab / (sa * sb)", "1.0", "cay / sa", "cby / sb", 900.0)} FROM z),
sol AS (SELECT * REPLACE (wa / sa AS wa, wb / sb AS wb) FROM u)"""
    + _terms_sql("wa", "wb", "my - wa * ma - wb * mb", "sol")
)
def ridge_normalized(spark, sf):
    return _params(Ridge(alpha=900.0, normalize=True).fit(_signal(spark, sf)), spark)


def _descent_sql(l1: str, l2: str, extra: str = "", stats: str = "st") -> str:
    """Coordinate descent on a 2 x 2 covariance as a recursive query."""

    def soft(z: str) -> str:
        return f"sign({z}) * greatest(abs({z}) - {l1}, 0)"

    za, zb = "(cay - cab * wb)", "(cby - cab * nwa)"
    return f"""
cd AS (SELECT 0 AS i, 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, {extra} caa, cab, cbb, cay, cby, ma, mb, my FROM {stats}
  UNION ALL SELECT i + 1, nwa, {soft(zb)} / (cbb + {l2}), {extra} caa, cab, cbb, cay, cby, ma, mb, my
  FROM (SELECT *, {soft(za)} / (caa + {l2}) AS nwa FROM cd WHERE i < 200) s),
sol AS (SELECT * FROM cd WHERE i = 200)"""


@query(
    f"WITH RECURSIVE {_STATS_SQL}, {_descent_sql('0.1', '0.0')}"
    + _terms_sql("wa", "wb", "my - wa * ma - wb * mb", "sol")
)
def lasso(spark, sf):
    return _params(Lasso(alpha=0.1, tolerance=1e-12).fit(_signal(spark, sf)), spark)


@query(
    f"WITH RECURSIVE {_STATS_SQL}, {_descent_sql('0.03', '0.07')}"
    + _terms_sql("wa", "wb", "my - wa * ma - wb * mb", "sol")
)
def elastic_net(spark, sf):
    model = ElasticNet(alpha=0.1, l1_ratio=0.3, tolerance=1e-12).fit(_signal(spark, sf))
    return _params(model, spark)


@query(
    f"WITH {_STATS_SQL}, sol AS (SELECT *, {_ridge_sql('caa', 'cab', 'cbb', 'cay', 'cby', 50.0)} FROM st)"
    " SELECT l_orderkey, l_linenumber, l_partkey, round(my + wa * (a - ma) + wb * (b - mb), 5) + 0.0 AS prediction"
    " FROM base, sol"
)
def ridge_predict(spark, sf):
    return _predictions(Ridge(alpha=50.0), spark, sf)


@query(
    f"WITH RECURSIVE {_STATS_SQL}, {_descent_sql('0.03', '0.07')}"
    " SELECT l_orderkey, l_linenumber, l_partkey, round(sol.my + wa * (a - sol.ma) + wb * (b - sol.mb), 5) + 0.0"
    " AS prediction FROM base, sol"
)
def elastic_net_predict(spark, sf):
    return _predictions(ElasticNet(alpha=0.1, l1_ratio=0.3, tolerance=1e-12), spark, sf)


@query(
    f"WITH RECURSIVE {_STATS_SQL}, {_descent_sql('0.1', '0.0')}"
    """ SELECT count(*) AS n, round(avg(e * e), 5) + 0.0 AS mse, round(avg(abs(e)), 5) + 0.0 AS mae,
  round(1 - avg(e * e) / var_pop(y), 6) + 0.0 AS r2
FROM (SELECT y, y - (sol.my + wa * (a - sol.ma) + wb * (b - sol.mb)) AS e FROM base, sol) t"""
)
def lasso_score(spark, sf):
    ds = _signal(spark, sf)
    found = Lasso(alpha=0.1, tolerance=1e-12).fit(ds).evaluate(ds)
    return found.select("n", r("mse", 5).alias("mse"), r("mae", 5).alias("mae"), r("r2").alias("r2"))


@query(
    f"""WITH RECURSIVE {_STATS_SQL},
zn AS (SELECT sqrt(caa) AS sa, sqrt(cbb) AS sb, 1.0::DOUBLE AS caa, cab / sqrt(caa * cbb) AS cab, 1.0::DOUBLE AS cbb,
  cay / sqrt(caa) AS cay, cby / sqrt(cbb) AS cby, ma, mb, my FROM st),
{_descent_sql('0.1', '0.0', 'sa, sb,', 'zn')}"""
    + _terms_sql("wa / sa", "wb / sb", "my - wa / sa * ma - wb / sb * mb", "sol")
)
def lasso_normalized(spark, sf):
    return _params(Lasso(alpha=0.1, normalize=True, tolerance=1e-12).fit(_signal(spark, sf)), spark)


def _predictions(estimator, spark, sf) -> DataFrame:
    ds = _signal(spark, sf)
    scored = estimator.fit(ds).transform(ds.df)
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", r("prediction", 5).alias("prediction"))


_HALVES_SQL = f"""{_STATS_SQL},
t AS (SELECT *, row_number() OVER (ORDER BY {_KEY_SQL}) - 1 AS i, count(*) OVER () AS m FROM base),
s AS (SELECT *, i < m - CAST(floor(m * 0.3 + 0.5) AS BIGINT) AS train FROM t),
f AS (SELECT count(*)::DOUBLE AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, covar_pop(a, a) AS caa,
  covar_pop(a, b) AS cab, covar_pop(b, b) AS cbb, covar_pop(a, y) AS cay, covar_pop(b, y) AS cby
  FROM s WHERE train)"""


@query(
    f"""WITH RECURSIVE {_HALVES_SQL},
al AS (SELECT f.*, l1 FROM f, (VALUES (0.01::DOUBLE), (0.1::DOUBLE), (1.0::DOUBLE), (10.0::DOUBLE)) v(l1)),
{_descent_sql("l1", "0.0", "l1,", "al")},
e AS (SELECT l1, wa, wb, my - wa * ma - wb * mb AS c,
  1 - (SELECT sum((y - sol.wa * a - sol.wb * b - (sol.my - sol.wa * sol.ma - sol.wb * sol.mb)) ** 2)
     / (count(*) * var_pop(y)) FROM s WHERE NOT train) AS r2 FROM sol)
SELECT l1 AS alpha, round(r2, 6) + 0.0 AS test_r2, round(c, 5) + 0.0 AS intercept,
  round(wa, 5) + 0.0 AS w_quantity, round(wb, 5) + 0.0 AS w_discount FROM e"""
)
def lasso_path(spark, sf):
    train, test = _signal(spark, sf).train_test_split(0.3)
    path = regularization_path(
        train, test, [0.01, 0.1, 1.0, 10.0], lambda alpha: Lasso(alpha, tolerance=1e-12)
    )
    return path.select(
        "alpha",
        r("test_r2").alias("test_r2"),
        r("intercept", 5).alias("intercept"),
        r(F.get("coefficients", 0), 5).alias("w_quantity"),
        r(F.get("coefficients", 1), 5).alias("w_discount"),
    )


@query(
    f"""WITH RECURSIVE {_HALVES_SQL},
al AS (SELECT f.*, model, l1, l2 FROM f, (VALUES ('ols', 0.0::DOUBLE, 0.0::DOUBLE), ('ridge', 0.0, 50.0 / (SELECT n FROM f)),
  ('lasso', 0.1, 0.0), ('elastic_net', 0.05, 0.05)) v(model, l1, l2)),
{_descent_sql("l1", "l2", "model, l1, l2,", "al")},
e AS (SELECT model, wa, wb, my - wa * ma - wb * mb AS c FROM sol),
q AS (SELECT model, train, 1 - sum((y - wa * a - wb * b - c) ** 2) / (count(*) * var_pop(y)) AS r2
  FROM s, e GROUP BY model, train)
SELECT e.model, round(p.r2, 6) + 0.0 AS train_r2, round(q.r2, 6) + 0.0 AS test_r2,
  round(wa, 5) + 0.0 AS w_quantity, round(wb, 5) + 0.0 AS w_discount
FROM e JOIN q p ON p.model = e.model AND p.train JOIN q ON q.model = e.model AND NOT q.train"""
)
def model_compare(spark, sf):
    train, test = _signal(spark, sf).train_test_split(0.3)
    table = compare_models(
        train,
        test,
        {
            "ols": LinearRegression(),
            "ridge": Ridge(alpha=50.0),
            "lasso": Lasso(alpha=0.1, tolerance=1e-12),
            "elastic_net": ElasticNet(alpha=0.1, l1_ratio=0.5, tolerance=1e-12),
        },
    )
    return table.select(
        "model",
        r("train_r2").alias("train_r2"),
        r("test_r2").alias("test_r2"),
        r(F.get("coefficients", 0), 5).alias("w_quantity"),
        r(F.get("coefficients", 1), 5).alias("w_discount"),
    )


# --- logistic ----------------------------------------------------------------

_LOGIT_BASE_SQL = """
base AS (SELECT o_orderkey, floor(o_totalprice / 50000) AS x, CAST(o_totalprice *
  CASE WHEN o_orderstatus = 'F' THEN 0.5 ELSE 1.0 END > 150000 AS DOUBLE) AS y FROM orders),
g AS (SELECT list({'x': x, 'w': w, 'p': p}) AS rows, sum(w)::DOUBLE AS n
  FROM (SELECT x, count(*)::DOUBLE AS w, sum(y) AS p FROM base GROUP BY x) t)"""
_P_SQL = "(1 / (1 + exp(-(w0 + w1 * r.x))))"


def _list_sum(term: str) -> str:
    return f"list_sum(list_transform(rows, lambda r: {term}))"


_LOGIT_GD_SQL = f"""{_LOGIT_BASE_SQL},
gd AS (SELECT 0 AS i, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 1e308::DOUBLE AS prev, 0 AS calm, false AS done
  UNION ALL
  SELECT i + 1, CASE WHEN stop THEN w0 ELSE w0 - 0.01 * g0 END, CASE WHEN stop THEN w1 ELSE w1 - 0.01 * g1 END,
    loss, c, stop FROM (
    SELECT *, c > 10 AS stop FROM (
      SELECT *, CASE WHEN abs(prev - loss) < 1e-6 THEN calm + 1 ELSE 0 END AS c FROM (
        SELECT i, w0, w1, prev, calm, done, {_list_sum(f"r.w * {_P_SQL} - r.p")} / n AS g0,
          {_list_sum(f"(r.w * {_P_SQL} - r.p) * r.x")} / n AS g1,
          -{_list_sum(f"r.p * ln({_P_SQL}) + (r.w - r.p) * ln(1 - {_P_SQL})")} / n AS loss
        FROM gd, g WHERE i < 1000 AND NOT done) a) b) c),
sol AS (SELECT w0, w1 FROM gd ORDER BY i DESC LIMIT 1)"""


def _logit(spark, sf) -> TabularDataset:
    half = F.when(F.col("o_orderstatus") == "F", 0.5).otherwise(1.0)
    df = read_table(spark, sf, "orders").select(
        "o_orderkey",
        F.floor(F.col("o_totalprice") / 50000).cast("double").alias("x"),
        (F.col("o_totalprice") * half > 150000).cast("double").alias("y"),
    )
    return TabularDataset(df, ["x"], "y", ["o_orderkey"])


_LOGIT_TERMS_SQL = """SELECT 'intercept' AS term, round(w0, {0}) + 0.0 AS value FROM sol
UNION ALL SELECT 'x', round(w1, {0}) + 0.0 FROM sol"""


@query(f"WITH RECURSIVE {_LOGIT_GD_SQL} {_LOGIT_TERMS_SQL.format(6)}")
def logistic_gd(spark, sf):
    return _params(LogisticRegression().fit(_logit(spark, sf)), spark, 6)


@query(
    f"""WITH RECURSIVE {_LOGIT_GD_SQL}
SELECT o_orderkey, round(1 / (1 + exp(-(w0 + w1 * x))), 6) + 0.0 AS probability,
  CASE WHEN 1 / (1 + exp(-(w0 + w1 * x))) >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM base, sol"""
)
def logistic_predict(spark, sf):
    ds = _logit(spark, sf)
    scored = LogisticRegression().fit(ds).transform(ds.df)
    return scored.select("o_orderkey", r("probability").alias("probability"), "prediction")


@query(
    f"""WITH RECURSIVE {_LOGIT_GD_SQL},
p AS (SELECT y, 1 / (1 + exp(-(w0 + w1 * x))) AS p FROM base, sol)
SELECT round(avg(CAST((p >= 0.5) = (y = 1) AS DOUBLE)), 6) + 0.0 AS accuracy,
  round(avg(-y * ln(p) - (1 - y) * ln(1 - p)), 6) + 0.0 AS log_loss FROM p"""
)
def logistic_score(spark, sf):
    ds = _logit(spark, sf)
    result = LogisticRegression().fit(ds).evaluate(ds)
    return result.select(r("accuracy").alias("accuracy"), r("log_loss").alias("log_loss"))


@query(
    f"""WITH RECURSIVE {_LOGIT_BASE_SQL},
nt AS (SELECT 0 AS i, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1 UNION ALL
  SELECT i + 1, w0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), w1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01)
  FROM (SELECT i, w0, w1, {_list_sum(f"r.w * {_P_SQL} - r.p")} AS g0,
    {_list_sum(f"(r.w * {_P_SQL} - r.p) * r.x")} AS g1,
    {_list_sum(f"r.w * {_P_SQL} * (1 - {_P_SQL})")} AS h00,
    {_list_sum(f"r.w * {_P_SQL} * (1 - {_P_SQL}) * r.x")} AS h01,
    {_list_sum(f"r.w * {_P_SQL} * (1 - {_P_SQL}) * r.x * r.x")} AS h11 FROM nt, g WHERE i < 30) t),
sol AS (SELECT w0, w1 FROM nt ORDER BY i DESC LIMIT 1) {_LOGIT_TERMS_SQL.format(2)}"""
)
def logistic_mle(spark, sf):
    return _params(LogisticRegression(solver="mle").fit(_logit(spark, sf)), spark, 2)


# --- support vectors ---------------------------------------------------------

# Prices moved 25 away from the middle on both sides: separable with a gap.
_GAP_SQL = """
mid AS (SELECT avg(p_retailprice) AS m FROM part),
d AS (SELECT p_partkey, (p_retailprice - m + CASE WHEN p_retailprice >= m THEN 25 ELSE -25 END) / 10 AS x,
  CASE WHEN p_retailprice >= m THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y FROM part, mid),
e AS (SELECT max(x) FILTER (y < 0) AS lo, min(x) FILTER (y > 0) AS hi FROM d)"""


def _gap(spark, sf) -> TabularDataset:
    part = read_table(spark, sf, "part")
    mid = F.lit(part.agg(F.avg("p_retailprice")).head()[0])
    above = F.col("p_retailprice") >= mid
    df = part.select(
        "p_partkey",
        ((F.col("p_retailprice") - mid + F.when(above, 25.0).otherwise(-25.0)) / 10).alias("x"),
        F.when(above, 1.0).otherwise(-1.0).alias("y"),
    )
    return TabularDataset(df, ["x"], "y", ["p_partkey"])


@query(
    f"""WITH {_GAP_SQL}
SELECT p_partkey, y, CASE WHEN x - (lo + hi) / 2 >= 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS prediction,
  round((x - (lo + hi) / 2) * 2 / (hi - lo), 3) + 0.0 AS score FROM d, e"""
)
def svc_linear(spark, sf):
    ds = _gap(spark, sf)
    model = SVC(kernel="linear", tolerance=1e-7).fit(ds)
    scored = model.decision_function(model.predict(ds.df))
    return scored.select("p_partkey", "y", "prediction", r("score", 3).alias("score"))


@query(f"WITH {_GAP_SQL} SELECT p_partkey, y FROM d, e WHERE x = lo OR x = hi")
def svc_support(spark, sf):
    ds = _gap(spark, sf)
    model = SVC(kernel="linear", tolerance=1e-6).fit(ds)
    return model.support_vectors(ds).select("p_partkey", "y")


# A disc and its surroundings, pulled apart by a third of the radius.
_RING_SQL = """
xy AS (SELECT event_id, ln(1 + value) - 3.5 AS a,
  (extract('hour' FROM ts) + extract('minute' FROM ts) / 60.0 - 12) / 6 AS b FROM events),
ring AS (SELECT event_id, CASE WHEN a * a + b * b < 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y FROM xy)"""


def _ring(spark, sf) -> TabularDataset:
    hour = F.hour("ts") + F.minute("ts") / 60.0
    df = read_table(spark, sf, "events").select(
        "event_id",
        (F.log(1 + F.col("value")) - 3.5).alias("a"),
        ((hour - 12) / 6).alias("b"),
    )
    inside = F.col("a") * F.col("a") + F.col("b") * F.col("b") < 1
    scale = F.when(inside, 0.75).otherwise(1.25)
    df = df.select(
        "event_id",
        (F.col("a") * scale).alias("a"),
        (F.col("b") * scale).alias("b"),
        F.when(inside, 1.0).otherwise(-1.0).alias("y"),
    )
    return TabularDataset(df, ["a", "b"], "y", ["event_id"])


_RING_LABELS_SQL = f"WITH {_RING_SQL} SELECT event_id, y, y AS prediction FROM ring"


@query(_RING_LABELS_SQL)
def svc_rbf(spark, sf):
    """The gap makes the classes separable, so every row must come out right."""
    ds = _ring(spark, sf)
    model = SVC(c=10.0, kernel="rbf", gamma=2.0, tolerance=0.01).fit(ds)
    return model.predict(ds.df).select("event_id", "y", "prediction")


@query(_RING_LABELS_SQL)
def svc_polynomial(spark, sf):
    """A circle is a degree-2 boundary: the explicit map separates it."""
    ds = _ring(spark, sf)
    model = SVC(c=10.0, kernel="polynomial", degree=2, coef0=1.0).fit(ds)
    return model.predict(ds.df).select("event_id", "y", "prediction")


@query(_RING_LABELS_SQL)
def svc_nystrom(spark, sf):
    """Landmark approximation of the RBF machine; the gap leaves it room."""
    ds = _ring(spark, sf)
    model = SVC(c=10.0, gamma=2.0, approximation="nystrom", landmarks=60, tolerance=0.1).fit(ds)
    return model.predict(ds.df).select("event_id", "y", "prediction")


@query(
    f"""WITH {_GAP_SQL}, c(model) AS (VALUES ('C=0.1'), ('C=1'), ('C=10'))
SELECT model, CAST((SELECT lo < hi FROM e) AS DOUBLE) AS train_accuracy,
  CAST((SELECT lo < hi FROM e) AS DOUBLE) AS test_accuracy,
  (SELECT count(*) FROM d, e WHERE x = lo OR x = hi) AS n_support FROM c"""
)
def svc_c_sweep(spark, sf):
    ds = _gap(spark, sf)
    _, test = ds.train_test_split(0.3)
    table = c_sweep(ds, test, [0.1, 1.0, 10.0], kernel="linear", tolerance=1e-6)
    return table.select("model", "train_accuracy", "test_accuracy", "n_support")


@query(
    f"""WITH {_GAP_SQL}, k(model) AS (VALUES ('linear'), ('polynomial'), ('rbf'), ('sigmoid'))
SELECT model, CAST((SELECT lo < hi FROM e) AS DOUBLE) AS train_accuracy,
  CAST((SELECT lo < hi FROM e) AS DOUBLE) AS test_accuracy FROM k"""
)
def svc_kernel_sweep(spark, sf):
    """Each kernel is monotone enough in one dimension to separate the gap."""
    ds = _gap(spark, sf)
    table = kernel_sweep(ds, ds, gamma=0.5, degree=3, coef0=0.0)
    return table.select("model", "train_accuracy", "test_accuracy")


# --- k-means -----------------------------------------------------------------

_KM_ROUNDS = 8


def _points(spark, sf) -> TabularDataset:
    df = read_table(spark, sf, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") / 1000).alias("x"),
        (F.col("c_nationkey") / 5).alias("y"),
    )
    return TabularDataset(df, ["x", "y"], order_by=["c_custkey"])


def _kmeans(k: int = 3, **params) -> KMeans:
    return KMeans(k, max_iter=_KM_ROUNDS, tolerance=0.0, **params)


def _kmeans_sql(k: int, seeds: list[int] | None = None, tag: str = "") -> str:
    """Unrolled Lloyd rounds from the rows at the given positions.

    By default row 42 and then the first rows that are not yet a centre.
    """
    pick = (
        f"CASE {' '.join(f'WHEN i = {s} THEN {c}' for c, s in enumerate(seeds))} END"
        if seeds
        else f"CASE WHEN i = 42 THEN 0 WHEN i < {k - 1} THEN i + 1 END"
    )
    sql = f"""p AS MATERIALIZED (SELECT c_custkey, c_acctbal / 1000 AS x, c_nationkey / 5 AS y,
  row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer),
c{tag}0 AS MATERIALIZED (SELECT {pick} AS k, x, y FROM p WHERE {pick} IS NOT NULL)"""
    for it in range(_KM_ROUNDS):
        sql += f""",
a{tag}{it} AS MATERIALIZED (SELECT p.*, k FROM p JOIN LATERAL (SELECT k FROM c{tag}{it} c
  ORDER BY sqrt((p.x - c.x) ** 2 + (p.y - c.y) ** 2), k LIMIT 1) n ON true),
c{tag}{it + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.x, c.x) AS x, coalesce(m.y, c.y) AS y FROM c{tag}{it} c
  LEFT JOIN (SELECT k, avg(x) AS x, avg(y) AS y FROM a{tag}{it} GROUP BY k) m ON m.k = c.k)"""
    last = _KM_ROUNDS
    sql += f""",
lab{tag} AS MATERIALIZED (SELECT * FROM a{tag}{last - 1}), cen{tag} AS (SELECT * FROM c{tag}{last}),
ine{tag} AS (SELECT sum((l.x - c.x) ** 2 + (l.y - c.y) ** 2) AS inertia FROM lab{tag} l JOIN cen{tag} c ON c.k = l.k)"""
    return sql


@query(
    f"""WITH {_kmeans_sql(3)}
SELECT CAST(k AS BIGINT) AS cluster, round(x, 5) + 0.0 AS x, round(y, 5) + 0.0 AS y FROM cen"""
)
def kmeans_centers(spark, sf):
    table = _kmeans().fit(_points(spark, sf)).centers_table(spark)
    wide = table.groupBy(F.col("cluster").cast("long").alias("cluster")).pivot("feature", ["x", "y"])
    wide = wide.agg(F.first("value"))
    return wide.select("cluster", r("x", 5).alias("x"), r("y", 5).alias("y"))


@query(f"WITH {_kmeans_sql(3)} SELECT c_custkey, CAST(k AS DOUBLE) AS cluster FROM lab")
def kmeans_labels(spark, sf):
    return _kmeans().fit_predict(_points(spark, sf)).select("c_custkey", "cluster")


@query(
    f"""WITH {_kmeans_sql(3)}
SELECT c_custkey, CAST((SELECT k FROM cen c ORDER BY (p.x - c.x) ** 2 + (p.y - c.y) ** 2, k LIMIT 1) AS DOUBLE)
  AS cluster FROM p"""
)
def kmeans_predict(spark, sf):
    ds = _points(spark, sf)
    return _kmeans().fit(ds).predict(ds.df).select("c_custkey", "cluster")


@query(
    f"""WITH {_kmeans_sql(3)}
SELECT c_custkey, {", ".join(f"round(sqrt((p.x - c{k}.x) ** 2 + (p.y - c{k}.y) ** 2), 5) + 0.0 AS d{k}" for k in range(3))}
FROM p, {", ".join(f"(SELECT * FROM cen WHERE k = {k}) c{k}" for k in range(3))}"""
)
def kmeans_transform(spark, sf):
    ds = _points(spark, sf)
    out = _kmeans().fit(ds).transform(ds.df)
    return out.select("c_custkey", *[r(F.get("distances", k), 5).alias(f"d{k}") for k in range(3)])


@query(f"WITH {_kmeans_sql(3)} SELECT round(inertia, 4) + 0.0 AS inertia FROM ine")
def kmeans_inertia(spark, sf):
    model = _kmeans().fit(_points(spark, sf))
    return spark.createDataFrame([(model.inertia,)], "inertia double").select(
        r("inertia", 4).alias("inertia")
    )


@query(f"WITH {_kmeans_sql(3)} SELECT CAST(k AS DOUBLE) AS cluster, count(*) AS size FROM lab GROUP BY k")
def kmeans_sizes(spark, sf):
    return _kmeans().fit(_points(spark, sf)).sizes(spark)


@query(
    f"""WITH {_kmeans_sql(4, [42, 59, 76, 93])}
SELECT c_custkey, CAST(k AS DOUBLE) AS cluster FROM lab"""
)
def kmeans_random_init(spark, sf):
    return _kmeans(4, init="random").fit_predict(_points(spark, sf)).select("c_custkey", "cluster")


def _kmeans_sweep_sql(ks: list[int]) -> str:
    parts = []
    for k in ks:
        body = _kmeans_sql(k, tag=f"_{k}_")
        parts.append(body if k == ks[0] else body[body.index(f"c_{k}_0 AS") :])
    union = " UNION ALL ".join(
        f"SELECT CAST({k} AS BIGINT) AS k, round(inertia, 4) + 0.0 AS inertia,"
        f" (SELECT count(DISTINCT k) FROM lab_{k}_) AS n_labels FROM ine_{k}_"
        for k in ks
    )
    return f"WITH {', '.join(parts)} {union}"


@query(_kmeans_sweep_sql([2, 3, 4, 5]))
def kmeans_k_sweep(spark, sf):
    table = kmeans_sweep(_points(spark, sf), [2, 3, 4, 5], max_iter=_KM_ROUNDS, tolerance=0.0)
    return table.select(
        F.col("k").cast("long").alias("k"),
        r("inertia", 4).alias("inertia"),
        F.col("n_labels").cast("long").alias("n_labels"),
    )


# --- DBSCAN ------------------------------------------------------------------


def _dbscan_sql(points: str, dist: str, eps: float, min_samples: int, tag: str = "") -> str:
    """Self-join, then the least core row reachable from each core row."""
    return f"""
pt{tag} AS MATERIALIZED ({points}),
nb{tag} AS MATERIALIZED (SELECT p.i AS a, q.i AS b FROM pt{tag} p, pt{tag} q WHERE {dist} <= {eps}),
co{tag} AS MATERIALIZED (SELECT a AS i FROM nb{tag} GROUP BY a HAVING count(*) >= {min_samples}),
ce{tag} AS MATERIALIZED (SELECT a, b FROM nb{tag} WHERE a IN (FROM co{tag}) AND b IN (FROM co{tag})),
re{tag}(i, root) AS (SELECT i, i FROM co{tag} UNION
  SELECT e.b, r.root FROM re{tag} r JOIN ce{tag} e ON e.a = r.i WHERE r.root < e.b),
cl{tag} AS MATERIALIZED (SELECT i, min(root) AS root FROM re{tag} GROUP BY i),
nu{tag} AS (SELECT root, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root FROM cl{tag})),
lb{tag} AS MATERIALIZED (SELECT p.*, CAST(coalesce(own.cluster, near.cluster, -1) AS DOUBLE) AS cluster,
  CAST(own.cluster IS NOT NULL AS INT) AS is_core FROM pt{tag} p
  LEFT JOIN (SELECT i, cluster FROM cl{tag} JOIN nu{tag} USING (root)) own ON own.i = p.i
  LEFT JOIN (SELECT n.a AS i, min(u.cluster) AS cluster FROM nb{tag} n JOIN cl{tag} c ON c.i = n.b
    JOIN nu{tag} u ON u.root = c.root GROUP BY n.a) near ON near.i = p.i)"""


_CUST_SQL = """SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS i, c_acctbal / 500 AS x,
  c_nationkey::DOUBLE AS y FROM customer"""
_SUPP_SQL = """SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS i, s_acctbal / 1000 AS x,
  s_nationkey / 4 AS y FROM supplier"""
_EMB_SQL = """SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i, embedding::DOUBLE[] AS e FROM embeddings"""
_L2_SQL = "sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y))"
_L1_SQL = "abs(p.x - q.x) + abs(p.y - q.y)"


def _customers(spark, sf) -> TabularDataset:
    df = read_table(spark, sf, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 500).alias("x"), F.col("c_nationkey").cast("double").alias("y")
    )
    return TabularDataset(df, ["x", "y"], order_by=["c_custkey"])


def _suppliers(spark, sf) -> TabularDataset:
    df = read_table(spark, sf, "supplier").select(
        "s_suppkey", (F.col("s_acctbal") / 1000).alias("x"), (F.col("s_nationkey") / 4).alias("y")
    )
    return TabularDataset(df, ["x", "y"], order_by=["s_suppkey"])


@query(
    f"WITH RECURSIVE {_dbscan_sql(_CUST_SQL, _L2_SQL, 0.5, 4)} SELECT c_custkey, cluster, is_core FROM lb"
)
def dbscan_labels(spark, sf):
    out = DBSCAN(0.5, 4).fit_predict(_customers(spark, sf))
    return out.select("c_custkey", "cluster", F.col("is_core").cast("int").alias("is_core"))


@query(
    f"""WITH RECURSIVE {_dbscan_sql(_CUST_SQL, _L2_SQL, 0.5, 4)}
SELECT count(DISTINCT cluster) FILTER (cluster >= 0) AS n_clusters, count(*) FILTER (cluster < 0) AS n_noise,
  count(*) FILTER (is_core = 1) AS n_core FROM lb"""
)
def dbscan_summary(spark, sf):
    return DBSCAN(0.5, 4).fit(_customers(spark, sf)).summary()


@query(
    f"""WITH RECURSIVE {_dbscan_sql(_SUPP_SQL, _L1_SQL, 0.9, 3)}
SELECT s_suppkey, cluster, is_core FROM lb"""
)
def dbscan_manhattan(spark, sf):
    out = DBSCAN(0.9, 3, metric="manhattan").fit_predict(_suppliers(spark, sf))
    return out.select("s_suppkey", "cluster", F.col("is_core").cast("int").alias("is_core"))


@query(
    f"""WITH RECURSIVE {_dbscan_sql(_SUPP_SQL, _L2_SQL, 0.7, 3)}
SELECT cluster, count(*) AS size FROM lb GROUP BY cluster"""
)
def dbscan_sizes(spark, sf):
    return DBSCAN(0.7, 3).fit(_suppliers(spark, sf)).sizes()


_DB_GRID = [(0.5, 3), (0.8, 3), (0.8, 5)]


@query(
    "WITH RECURSIVE "
    + ", ".join(_dbscan_sql(_SUPP_SQL, _L2_SQL, e, m, f"_{t}") for t, (e, m) in enumerate(_DB_GRID))
    + " UNION ALL ".join(
        f""" SELECT {e}::DOUBLE AS eps, CAST({m} AS BIGINT) AS min_samples,
  count(DISTINCT cluster) FILTER (cluster >= 0) AS n_clusters, count(*) FILTER (cluster < 0) AS n_noise,
  count(*) FILTER (is_core = 1) AS n_core FROM lb_{t}"""
        for t, (e, m) in enumerate(_DB_GRID)
    )
)
def dbscan_grid(spark, sf):
    table = dbscan_sweep(_suppliers(spark, sf), _DB_GRID)
    return table.withColumn("min_samples", F.col("min_samples").cast("long"))


@query(
    f"""WITH RECURSIVE {_dbscan_sql(_EMB_SQL, "list_distance(p.e, q.e)", 1.15, 3)}
SELECT vec_id, cluster, is_core FROM lb"""
)
def dbscan_embeddings(spark, sf):
    ds = TabularDataset(read_table(spark, sf, "embeddings"), "embedding", order_by=["vec_id"])
    out = DBSCAN(1.15, 3).fit_predict(ds)
    return out.select("vec_id", "cluster", F.col("is_core").cast("int").alias("is_core"))


@query(
    """SELECT vec_id FROM embeddings WHERE list_distance(embedding::DOUBLE[],
  list_transform(range(1, 65), lambda i: i / 640)) <= 1.15"""
)
def region_rows(spark, sf):
    ds = TabularDataset(read_table(spark, sf, "embeddings"), "embedding")
    return region_query(ds, [i / 640 for i in range(1, 65)], 1.15).select("vec_id")


# --- decomposition -----------------------------------------------------------

_PAIR_SQL = "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS a, l_extendedprice / 1000 AS b FROM lineitem"


def _pair(spark, sf) -> TabularDataset:
    df = read_table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").alias("a"),
        (F.col("l_extendedprice") / 1000).alias("b"),
    )
    return TabularDataset(df, ["a", "b"])


# Eigenpairs of a symmetric 2 x 2 matrix (p, q; q, s) in closed form, unit
# vectors with a positive sum.
_EIGEN_SQL = """
v AS (SELECT *, (p + s) / 2 + sqrt(((p - s) / 2) ** 2 + q * q) AS l1,
  (p + s) / 2 - sqrt(((p - s) / 2) ** 2 + q * q) AS l2 FROM m),
u AS (SELECT *, q / sqrt(q * q + (l1 - p) ** 2) AS a1, (l1 - p) / sqrt(q * q + (l1 - p) ** 2) AS b1,
  q / sqrt(q * q + (l2 - p) ** 2) AS a2, (l2 - p) / sqrt(q * q + (l2 - p) ** 2) AS b2 FROM v),
eig AS (SELECT * REPLACE (a1 * sign(a1 + b1) AS a1, b1 * sign(a1 + b1) AS b1,
  a2 * sign(a2 + b2) AS a2, b2 * sign(a2 + b2) AS b2) FROM u)"""

_PCA_SQL = f"""WITH t AS ({_PAIR_SQL}),
m AS (SELECT covar_samp(a, a) AS p, covar_samp(a, b) AS q, covar_samp(b, b) AS s, avg(a) AS ma, avg(b) AS mb FROM t),
{_EIGEN_SQL}"""


@query(
    f"""{_PCA_SQL}
SELECT CAST(0 AS BIGINT) AS component, round(l1, 5) + 0.0 AS variance, round(l1 / (l1 + l2), 6) + 0.0 AS ratio,
  round(a1, 5) + 0.0 AS wa, round(b1, 5) + 0.0 AS wb FROM eig
UNION ALL SELECT 1, round(l2, 5) + 0.0, round(l2 / (l1 + l2), 6) + 0.0, round(a2, 5) + 0.0, round(b2, 5) + 0.0 FROM eig"""
)
def pca_components(spark, sf):
    model = PCA().fit(_pair(spark, sf))
    rows = [
        (i, float(v), float(q), float(w[0]), float(w[1]))
        for i, (v, q, w) in enumerate(
            zip(model.explained_variance, model.explained_variance_ratio, model.components, strict=True)
        )
    ]
    df = spark.createDataFrame(rows, "component long, variance double, ratio double, wa double, wb double")
    return df.select(
        "component",
        r("variance", 5).alias("variance"),
        r("ratio").alias("ratio"),
        r("wa", 5).alias("wa"),
        r("wb", 5).alias("wb"),
    )


@query(
    f"""{_PCA_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, round((a - ma) * a1 + (b - mb) * b1, 4) + 0.0 AS z0,
  round((a - ma) * a2 + (b - mb) * b2, 4) + 0.0 AS z1 FROM t, eig"""
)
def pca_transform(spark, sf):
    ds = _pair(spark, sf)
    out = PCA().fit(ds).transform(ds.df)
    return out.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        *[r(F.get("projected", i), 4).alias(f"z{i}") for i in range(2)],
    )


@query(
    f"""{_PCA_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, round(ma + a1 * ((a - ma) * a1 + (b - mb) * b1), 4) + 0.0 AS a,
  round(mb + b1 * ((a - ma) * a1 + (b - mb) * b1), 4) + 0.0 AS b FROM t, eig"""
)
def pca_inverse(spark, sf):
    ds = _pair(spark, sf)
    model = PCA(1).fit(ds)
    back = model.inverse_transform(model.transform(ds.df))
    return back.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        *[r(F.get("reconstructed", j), 4).alias(c) for j, c in enumerate(("a", "b"))],
    )


@query(
    f"""{_PCA_SQL}
SELECT round(-avg((a - ma - a1 * z) ** 2 + (b - mb - b1 * z) ** 2) / 2, 6) + 0.0 AS score
FROM (SELECT *, (a - ma) * a1 + (b - mb) * b1 AS z FROM t, eig) x"""
)
def pca_score(spark, sf):
    ds = _pair(spark, sf)
    value = PCA(1).fit(ds).score(ds)
    return spark.createDataFrame([(value,)], "score double").select(r("score").alias("score"))


@query(
    f"""WITH t AS ({_PAIR_SQL}) SELECT round(covar_samp(a, a), 5) + 0.0 AS aa, round(covar_samp(a, b), 5) + 0.0 AS ab,
  round(covar_samp(b, b), 5) + 0.0 AS bb FROM t"""
)
def pca_covariance(spark, sf):
    cov = PCA().fit(_pair(spark, sf)).get_covariance()
    df = spark.createDataFrame(
        [(float(cov[0, 0]), float(cov[0, 1]), float(cov[1, 1]))], "aa double, ab double, bb double"
    )
    return df.select(*[r(c, 5).alias(c) for c in df.columns])


@query(
    """SELECT CAST(l_linenumber AS BIGINT) AS line, count(*) AS n, round(avg(l_quantity), 6) + 0.0 AS mean_quantity,
  round(stddev_pop(l_quantity), 6) + 0.0 AS std_quantity,
  round(covar_pop(l_quantity, l_discount), 6) + 0.0 AS covariance FROM lineitem GROUP BY l_linenumber"""
)
def grouped_statistics(spark, sf):
    ds = _lineitem(spark, sf, ["l_quantity", "l_discount"])
    rows = [
        (int(g), m.n, float(m.mean[0]), float(m.std[0]), float(m.centered()[0, 1]) / m.n)
        for g, m in grouped_moments(ds.df, ds.features, "l_linenumber").items()
    ]
    schema = "line long, n long, mean_quantity double, std_quantity double, covariance double"
    df = spark.createDataFrame(rows, schema)
    return df.select("line", "n", *[r(c).alias(c) for c in df.columns[2:]])


_SVD_SQL = f"""WITH t AS ({_PAIR_SQL}),
m AS (SELECT sum(a * a) AS p, sum(a * b) AS q, sum(b * b) AS s, count(*) AS n FROM t), {_EIGEN_SQL}"""


@query(
    f"""{_SVD_SQL}
SELECT CAST(0 AS BIGINT) AS component, round(sqrt(l1), 4) + 0.0 AS sigma, round(l1 / (n - 1), 5) + 0.0 AS variance,
  round(l1 / (l1 + l2), 6) + 0.0 AS ratio FROM eig
UNION ALL SELECT 1, round(sqrt(l2), 4) + 0.0, round(l2 / (n - 1), 5) + 0.0, round(l2 / (l1 + l2), 6) + 0.0 FROM eig"""
)
def svd_values(spark, sf):
    model = TruncatedSVD(2).fit(_pair(spark, sf))
    rows = [
        (i, float(s), float(v), float(q))
        for i, (s, v, q) in enumerate(
            zip(
                model.singular_values,
                model.explained_variance,
                model.explained_variance_ratio,
                strict=True,
            )
        )
    ]
    df = spark.createDataFrame(rows, "component long, sigma double, variance double, ratio double")
    return df.select(
        "component",
        r("sigma", 4).alias("sigma"),
        r("variance", 5).alias("variance"),
        r("ratio").alias("ratio"),
    )


@query(
    f"""{_SVD_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, round(a * a1 + b * b1, 4) + 0.0 AS z0,
  round((a * a1 + b * b1) * a1, 4) + 0.0 AS a, round((a * a1 + b * b1) * b1, 4) + 0.0 AS b FROM t, eig"""
)
def svd_transform(spark, sf):
    ds = _pair(spark, sf)
    model = TruncatedSVD(1).fit(ds)
    back = model.inverse_transform(model.transform(ds.df))
    return back.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        r(F.get("projected", 0), 4).alias("z0"),
        r(F.get("reconstructed", 0), 4).alias("a"),
        r(F.get("reconstructed", 1), 4).alias("b"),
    )


@query(
    f"""WITH t AS ({_PAIR_SQL}),
c AS (SELECT covar_pop(a, a) AS p, covar_pop(a, b) AS q, covar_pop(b, b) AS s FROM t),
g AS (SELECT avg(a * a) AS p, avg(a * b) AS q, avg(b * b) AS s FROM t),
e AS (SELECT 'pca' AS method, p + s AS tr, (p + s) / 2 + sqrt(((p - s) / 2) ** 2 + q * q) AS l1 FROM c
  UNION ALL SELECT 'svd', p + s, (p + s) / 2 + sqrt(((p - s) / 2) ** 2 + q * q) FROM g)
SELECT method, CAST(1 AS BIGINT) AS k, round((tr - l1) / 2, 6) + 0.0 AS mse, round(l1 / tr, 6) + 0.0 AS variance_kept FROM e
UNION ALL SELECT method, 2, 0.0, 1.0 FROM e"""
)
def reconstruction(spark, sf):
    table = reconstruction_comparison(_pair(spark, sf), [1, 2])
    return table.select(
        "method",
        F.col("k").cast("long").alias("k"),
        r("mse").alias("mse"),
        r("variance_kept").alias("variance_kept"),
    )


# Two classes of embeddings (labels below 5, and the rest) on two coordinates.
_LDA_SQL = """WITH t AS (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b,
  CAST(label >= 5 AS DOUBLE) AS y FROM embeddings),
k AS (SELECT y, count(*) AS n, avg(a) AS ma, avg(b) AS mb, covar_pop(a, a) * count(*) AS p,
  covar_pop(a, b) * count(*) AS q, covar_pop(b, b) * count(*) AS s FROM t GROUP BY y),
w AS (SELECT sum(p) + 2e-6 AS p, sum(q) AS q, sum(s) + 2e-6 AS s, max(ma) FILTER (y = 1) - max(ma) FILTER (y = 0) AS da,
  max(mb) FILTER (y = 1) - max(mb) FILTER (y = 0) AS db, max(ma) FILTER (y = 0) AS a0, max(mb) FILTER (y = 0) AS b0,
  max(ma) FILTER (y = 1) AS a1, max(mb) FILTER (y = 1) AS b1 FROM k),
d AS (SELECT *, s * da - q * db AS va, p * db - q * da AS vb FROM w),
f AS (SELECT *, sign(va + vb) / sqrt(va * va + vb * vb) AS sc FROM d),
z AS (SELECT vec_id, y, (a * va + b * vb) * sc AS z, (a0 * va + b0 * vb) * sc AS z0,
  (a1 * va + b1 * vb) * sc AS z1 FROM t, f),
pr AS (SELECT *, CASE WHEN (z - z1) ** 2 < (z - z0) ** 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM z)"""


def _two_classes(spark, sf) -> TabularDataset:
    df = read_table(spark, sf, "embeddings").select(
        "vec_id",
        F.get("embedding", 0).cast("double").alias("a"),
        F.get("embedding", 1).cast("double").alias("b"),
        (F.col("label") >= 5).cast("double").alias("y"),
    )
    return TabularDataset(df, ["a", "b"], "y")


@query(f"{_LDA_SQL} SELECT vec_id, round(z, 5) + 0.0 AS z0 FROM pr")
def lda_transform(spark, sf):
    ds = _two_classes(spark, sf)
    out = LDA().fit(ds).transform(ds.df)
    return out.select("vec_id", r(F.get("projected", 0), 5).alias("z0"))


@query(f"{_LDA_SQL} SELECT vec_id, prediction FROM pr")
def lda_predict(spark, sf):
    ds = _two_classes(spark, sf)
    return LDA().fit(ds).predict(ds.df).select("vec_id", "prediction")


@query(f"{_LDA_SQL} SELECT count(*) AS n, round(avg(CAST(prediction = y AS DOUBLE)), 6) + 0.0 AS accuracy FROM pr")
def lda_score(spark, sf):
    ds = _two_classes(spark, sf)
    return LDA().fit(ds).evaluate(ds).select("n", r("accuracy").alias("accuracy"))


@query()
def lda_embeddings(spark, sf):
    """All ten classes on all 64 coordinates; rows only."""
    ds = TabularDataset(read_table(spark, sf, "embeddings"), "embedding", "label")
    return LDA().fit(ds).predict(ds.df).select("vec_id", "label", "prediction")


@query(
    """SELECT CAST(j AS BIGINT) AS j, round(sum(embedding[1]::DOUBLE * embedding[j]::DOUBLE), 5) + 0.0 AS gram
FROM embeddings, range(1, 65) t(j) GROUP BY j"""
)
def embeddings_gram(spark, sf):
    ds = TabularDataset(read_table(spark, sf, "embeddings"), "embedding")
    row = moments(ds.df, ds.features).raw()[0]
    df = spark.createDataFrame([(j + 1, float(v)) for j, v in enumerate(row)], "j long, gram double")
    return df.select("j", r("gram", 5).alias("gram"))


@query(
    """SELECT round(sum(v), 6) + 0.0 AS total_variance, CAST(64 AS BIGINT) AS n_components FROM
(SELECT var_samp(embedding[j]::DOUBLE) AS v FROM embeddings, range(1, 65) t(j) GROUP BY j) s"""
)
def embeddings_pca(spark, sf):
    model = PCA().fit(TabularDataset(read_table(spark, sf, "embeddings"), "embedding"))
    df = spark.createDataFrame(
        [(float(model.explained_variance.sum()), len(model.components))],
        "total_variance double, n_components long",
    )
    return df.select(r("total_variance").alias("total_variance"), "n_components")


# --- scalar building blocks --------------------------------------------------


@query(
    """WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, (l_quantity - 25) / 10 AS x, l_discount AS g FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, round(abs(x), 6) AS abs_x, round(x * x, 6) AS square_x,
  round(sqrt(abs(x)), 6) AS sqrt_x, round(exp(x), 5) AS exp_x, round(ln(1 + abs(x)), 6) AS ln_x,
  round(tanh(x), 6) + 0.0 AS tanh_x, round(pow(abs(x), 1.5), 6) AS pow_x, round(x) + 0.0 AS round_x,
  round(greatest(least(x, 1.0), -1.0), 6) + 0.0 AS clip_x, round(1 / (1 + exp(-x)), 6) AS sigmoid_x,
  round(sign(x) * greatest(abs(x) - g, 0), 6) + 0.0 AS soft_x FROM t"""
)
def scalar_functions(spark, sf):
    x = F.col("x")
    t = read_table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        ((F.col("l_quantity") - 25) / 10).alias("x"),
        F.col("l_discount").alias("g"),
    )
    return t.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        r(F.abs(x)).alias("abs_x"),
        r(x * x).alias("square_x"),
        r(F.sqrt(F.abs(x))).alias("sqrt_x"),
        r(F.exp(x), 5).alias("exp_x"),
        r(F.log(1 + F.abs(x))).alias("ln_x"),
        r(F.tanh(x)).alias("tanh_x"),
        r(F.pow(F.abs(x), F.lit(1.5))).alias("pow_x"),
        (V.round_half_away(x) + 0.0).alias("round_x"),
        r(V.clip(x, -1.0, 1.0)).alias("clip_x"),
        r(V.sigmoid(x)).alias("sigmoid_x"),
        r(V.soft_threshold(x, F.col("g"))).alias("soft_x"),
    )


@query(
    """WITH t AS (SELECT vec_id, embedding::DOUBLE[] AS e, list_transform(range(1, 65), lambda i: i / 640) AS c FROM embeddings)
SELECT vec_id, round(list_dot_product(e, c), 6) + 0.0 AS dot, round(list_distance(e, c), 6) + 0.0 AS l2,
  round(list_sum(list_transform(range(1, 65), lambda i: abs(e[i] - c[i]))), 6) + 0.0 AS l1 FROM t"""
)
def vector_functions(spark, sf):
    ds = TabularDataset(read_table(spark, sf, "embeddings"), "embedding")
    e, c = ds.features.vector(), [i / 640 for i in range(1, 65)]
    return ds.df.select(
        "vec_id",
        r(V.dot(e, c)).alias("dot"),
        r(V.euclidean(e, c)).alias("l2"),
        r(V.manhattan(e, c)).alias("l1"),
    )


# --- streaming ---------------------------------------------------------------


@query(
    """SELECT event_id, round((SELECT regr_intercept(value, user_id) FROM events)
  + (SELECT regr_slope(value, user_id) FROM events) * user_id, 6) + 0.0 AS prediction FROM events"""
)
def streaming_score(spark, sf):
    """Fit on the table, then score the same files as a stream."""
    events = read_table(spark, sf, "events")
    model = LinearRegression().fit(TabularDataset(events, ["user_id"], "value"))
    stream = read_stream(spark, sf, "events.parquet", events)
    folder = _scratch(spark)
    scored = score_available(
        stream,
        lambda df: model.transform(df).select("event_id", r("prediction").alias("prediction")),
        f"{folder}/out",
        f"{folder}/state",
    )
    return scored


# --- training-data operators -------------------------------------------------

try:
    import corpus_pipeline
    from gramspan.llm import queries as _llm
except ImportError as e:
    # The subpackage and its pipeline can be taken away; everything else still works.
    if e.name not in ("corpus_pipeline", "gramspan.llm", "gramspan.llm.common", "gramspan.llm.queries"):
        raise
else:
    _QUERIES.update(_llm.QUERIES, pipeline=corpus_pipeline.run)
    _ORACLES.update(_llm.ORACLES)
    if corpus_pipeline.ORACLE_SQL is not None:
        _ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


# --- contract ----------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: split, standardise, fit, predict and evaluate on lineitem."""
    return split_scale_fit_score(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
