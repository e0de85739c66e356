import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gramspan import functions as V
from gramspan.operators.scaler import StandardScaler
from gramspan.plans import gram
from gramspan.plans.gram import grouped_moments, moments
from gramspan.sources import TabularDataset, from_rows


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(5, 2, (120, 3))
    y = np.repeat([0.0, 1.0, 2.0], 40)
    return x, y, from_rows(spark, x.tolist(), y.tolist())


@pytest.mark.parametrize("limit", [0, 50])
@pytest.mark.parametrize("parts", [1, 20])
def test_both_forms_match_numpy(data, monkeypatch, limit, parts):
    monkeypatch.setattr(gram, "EXPRESSION_LIMIT", limit)
    x, y, ds = data
    z = np.column_stack([x, y])
    m = moments(ds.df.repartition(parts), ds.features, "y")
    assert m.n == 120
    np.testing.assert_allclose(m.mean, z.mean(axis=0))
    np.testing.assert_allclose(m.std, z.std(axis=0))
    np.testing.assert_allclose(m.raw(), z.T @ z)
    groups = grouped_moments(ds.df.repartition(parts), ds.features, "y")
    assert list(groups) == [0.0, 1.0, 2.0]
    np.testing.assert_allclose(groups[1.0].centered(), 40 * np.cov(x[40:80].T, ddof=0))


def test_array_features_match_columns(data):
    x, _, ds = data
    arrays = ds.df.select(F.array("x0", "x1", "x2").cast("array<float>").alias("v"))
    m = moments(arrays, TabularDataset(arrays, "v").features)
    np.testing.assert_allclose(m.raw(), x.astype("f4").astype(float).T @ x.astype("f4"), rtol=1e-6)


def test_far_from_zero_is_summed_again(spark):
    x = 1e8 + np.arange(50.0)
    ds = from_rows(spark, [[v] for v in x])
    np.testing.assert_allclose(moments(ds.df, ds.features).variance, [x.var()], rtol=1e-9)


def test_scaled_moments_equal_moments_of_scaled_data(data):
    x, y, ds = data
    m = moments(ds.df, ds.features)
    got = m.scaled(m.mean, m.std)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    np.testing.assert_allclose(got.raw(), z.T @ z, atol=1e-9)


@pytest.mark.parametrize("limit", [0, 50])
def test_nulls_and_empty_input_are_errors(spark, monkeypatch, limit):
    monkeypatch.setattr(gram, "EXPRESSION_LIMIT", limit)
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, y double")
    ds = TabularDataset(df, ["a"], "y")
    with pytest.raises(ValueError, match="null"):
        moments(df, ds.features, "y")
    with pytest.raises(ValueError):
        moments(df.limit(0), ds.features, "y")


def test_nan_propagates(spark):
    ds = from_rows(spark, [[1.0, math.nan], [2.0, 1.0]])
    m = moments(ds.df, ds.features)
    assert m.mean[0] == 1.5 and math.isnan(m.mean[1])


def test_scaler(spark):
    ds = from_rows(spark, [[1, 2], [3, 4], [5, 6]])
    model = StandardScaler().fit(ds)
    assert model.means == (3.0, 4.0)
    assert model.stds == pytest.approx((math.sqrt(8 / 3),) * 2)
    out = np.array([[r["x0"], r["x1"]] for r in model.transform(ds).df.orderBy("row_idx").collect()])
    np.testing.assert_allclose(out.mean(axis=0), 0, atol=1e-12)
    np.testing.assert_allclose(out.std(axis=0), 1)
    with pytest.raises(ValueError):
        StandardScaler().fit(ds.with_df(ds.df.limit(0)))


def test_constant_column(spark):
    ds = from_rows(spark, [[2.0], [2.0]])
    new = from_rows(spark, [[2.0], [3.0], [1.0]]).df
    got = [r["x0"] for r in StandardScaler().fit(ds).transform(new).orderBy("row_idx").collect()]
    assert math.isnan(got[0]) and got[1:] == [math.inf, -math.inf]
    zero = StandardScaler("zero").fit(ds).transform(new).collect()
    assert [r["x0"] for r in zero] == [0.0, 0.0, 0.0]


def test_scaling_an_array_column(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "v array<double>")
    ds = TabularDataset(df, "v")
    got = sorted(r["v"] for r in StandardScaler("zero").fit_transform(ds).df.collect())
    assert got == [[-1.0, 0.0], [1.0, 0.0]]
    nan = StandardScaler().fit_transform(ds).df.head()["v"][1]
    assert math.isnan(nan)


def test_scalar_functions(spark):
    df = spark.createDataFrame([(2.0,), (-2.0,), (0.5,), (2.5,), (-2.5,), (1000.0,), (-1000.0,)], "x double")
    x = F.col("x")
    rows = df.select(
        V.soft_threshold(x, 1.0).alias("s"), V.round_half_away(x).alias("r"), V.sigmoid(x).alias("g"),
        V.clip(x, -1, 1).alias("c"),
    ).collect()
    assert [r["s"] for r in rows[:3]] == [1.0, -1.0, 0.0]
    assert [r["r"] for r in rows[3:5]] == [3.0, -3.0]
    assert [r["g"] for r in rows[5:]] == [1.0, 0.0]
    assert rows[2]["c"] == 0.5 and rows[5]["c"] == 1.0
    assert df.limit(1).select(V.sigmoid(F.lit(0.0))).head()[0] == 0.5


def test_vector_functions_agree_in_both_forms(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    cols, arr, other = [F.col("a"), F.col("b")], F.array("a", "b"), [3.0, 4.0]
    for v in (cols, arr):
        r = df.select(
            V.dot(v, other), V.euclidean(v, other), V.manhattan(v, other)
        ).head()
        assert list(r) == [11.0, math.sqrt(8), 4.0]
    tie = df.select(V.nearest(cols, [[0.0, 2.0], [2.0, 2.0]])["k"]).head()[0]
    assert tie == 0
