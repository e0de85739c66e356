import numpy as np
import pytest
from pyspark.sql import functions as F

from gramspan.operators import (
    ElasticNet,
    Lasso,
    LinearRegression,
    Ridge,
    ScaledRegression,
    StandardScaler,
    compare_models,
    regularization_path,
)
from gramspan.sources import TabularDataset, from_rows

_RNG = np.random.default_rng(3)
REG = np.column_stack([np.arange(14) * 0.7, _RNG.uniform(0, 6, 14), _RNG.normal(0, 1, (14, 2))])
REG_Y = REG @ [3.0, 1.5, 0.4, 0.0] + 2 + _RNG.normal(0, 0.2, 14)


@pytest.fixture(scope="module")
def line(spark):
    return from_rows(spark, [[1], [2], [3], [4]], [2, 4, 6, 8])


@pytest.fixture(scope="module")
def reg(spark):
    return from_rows(spark, REG.tolist(), REG_Y.tolist())


def test_exact_line(line):
    m = LinearRegression().fit(line)
    assert m.coefficients == pytest.approx([2.0]) and m.intercept == pytest.approx(0.0)
    assert m.score(line) == pytest.approx(1.0)
    m = LinearRegression(fit_intercept=False).fit(line)
    assert m.coefficients == pytest.approx([2.0]) and m.intercept == 0.0


def test_collinear_gets_least_norm(spark):
    ds = from_rows(spark, [[0, 2], [1, 3], [3, 5], [6, 8]], [1, 4, 10, 19])
    m = LinearRegression().fit(ds)
    assert m.coefficients == pytest.approx([1.5, 1.5])
    assert m.score(ds) == pytest.approx(1.0)


def test_multi_matches_lstsq_and_predicts_new_rows(spark, reg):
    m = LinearRegression().fit(reg)
    a = np.column_stack([np.ones(14), REG])
    want = np.linalg.lstsq(a, REG_Y, rcond=None)[0]
    np.testing.assert_allclose(np.append(m.intercept, m.coefficients), want)
    new = from_rows(spark, [[1, 1, 1, 1]]).df
    assert m.transform(new).head()["prediction"] == pytest.approx(want.sum())
    with pytest.raises(ValueError):
        m.transform(new.drop("x3"))
    r = m.evaluate(reg).head()
    assert r["n"] == 14 and r["r2"] == pytest.approx(m.score(reg))


def test_ridge(spark, line):
    m = Ridge(alpha=1.0).fit(line)
    assert m.coefficients == pytest.approx([10 / 6])
    noisy = from_rows(spark, [[1], [2], [3], [4]], [2.2, 3.7, 6.2, 8.1])
    assert Ridge().fit(noisy).score(noisy) > 0.8
    assert Ridge(alpha=0.0, fit_intercept=False).fit(line).coefficients == pytest.approx([2.0])


def test_ridge_normalize_and_singular(spark):
    ds = from_rows(spark, [[1, 50], [2, 100], [3, 150], [4, 200]], [1, 2, 3, 4])
    m = Ridge(alpha=0.1, normalize=True).fit(ds)
    assert m.score(ds) > 0.5
    # Each column is scaled by its own deviation.
    assert m.coefficients[0] == pytest.approx(50 * m.coefficients[1])
    with pytest.raises(ValueError, match="singular"):
        Ridge(alpha=0.0).fit(ds)


@pytest.mark.parametrize("make", [Lasso, ElasticNet])
def test_sparse_and_strong_penalties(spark, line, make):
    sparse = from_rows(spark, [[1, 0, 0], [2, 0, 0], [3, 0, 0], [4, 0, 0]], [2, 4, 6, 8])
    m = make(alpha=0.1).fit(sparse)
    assert m.coefficients[1:] == pytest.approx([0, 0]) and m.score(sparse) > 0.8
    assert make(alpha=0.001).fit(line).coefficients[0] == pytest.approx(2.0, abs=0.2)
    assert abs(make(alpha=100.0).fit(line).coefficients[0]) < (0.1 if make is Lasso else 0.3)


@pytest.mark.parametrize("l1_ratio", [0.0, 0.4, 1.0])
@pytest.mark.parametrize("normalize", [False, True])
def test_optimality_conditions(reg, l1_ratio, normalize):
    alpha = 0.3
    m = ElasticNet(alpha, l1_ratio, normalize=normalize, tolerance=1e-13, max_iter=100_000).fit(reg)
    x, y = REG, REG_Y
    s = x.std(axis=0) if normalize else np.ones(4)
    z, b = (x - x.mean(axis=0)) / s, m.coefficients * s
    grad = z.T @ (y - y.mean() - z @ b) / len(y) - alpha * (1 - l1_ratio) * b
    for g, v in zip(grad, b):
        if v:
            assert g == pytest.approx(alpha * l1_ratio * np.sign(v), abs=1e-8)
        else:
            assert abs(g) <= alpha * l1_ratio + 1e-8


def test_penalties_and_parameter_errors():
    e = ElasticNet(alpha=1.0, l1_ratio=0.7)
    assert (e.l1_penalty, e.l2_penalty) == pytest.approx((0.7, 0.3))
    for bad in (lambda: Ridge(-1), lambda: Lasso(-1), lambda: ElasticNet(-1), lambda: ElasticNet(1, 1.5), lambda: ElasticNet(1, -0.1)):
        with pytest.raises(ValueError):
            bad()


def test_constant_column_gets_zero_when_normalised(spark):
    ds = from_rows(spark, [[1, 5], [2, 5], [3, 5]], [1, 2, 3])
    for make in (Ridge, Lasso, ElasticNet):
        assert make(alpha=0.01, normalize=True).fit(ds).coefficients[1] == 0.0


def test_compare_and_path_agree_with_single_fits(reg):
    train, test = reg.train_test_split(0.3)
    table = {r["model"]: r for r in compare_models(train, test, {"ols": LinearRegression(), "lasso": Lasso(0.1)}).collect()}
    for name, est in (("ols", LinearRegression()), ("lasso", Lasso(0.1))):
        m = est.fit(train)
        assert table[name]["test_r2"] == pytest.approx(m.score(test))
        assert table[name]["train_r2"] == pytest.approx(m.score(train))
        assert table[name]["coefficients"] == pytest.approx(list(m.coefficients))
    path = regularization_path(train, test, [0.01, 0.1, 1.0]).orderBy("alpha").collect()
    assert [r["alpha"] for r in path] == [0.01, 0.1, 1.0]
    assert path[1]["test_r2"] == pytest.approx(Lasso(0.1).fit(train).score(test))


def test_folded_scaling_equals_two_steps(reg):
    scaler, folded = ScaledRegression(Ridge(2.0)).fit(reg)
    scaled = StandardScaler().fit_transform(reg)
    direct = Ridge(2.0).fit(scaled)
    np.testing.assert_allclose(folded.coefficients, direct.coefficients)
    assert folded.score(scaler.transform(reg)) == pytest.approx(direct.score(scaled))


def test_array_features_and_order_do_not_matter(spark, reg):
    df = reg.df.select(F.array("x0", "x1", "x2", "x3").alias("v"), "y").orderBy(F.desc("y")).repartition(5)
    a = LinearRegression().fit(TabularDataset(df, "v", "y"))
    b = LinearRegression().fit(reg)
    np.testing.assert_allclose(a.coefficients, b.coefficients)
    assert a.score(TabularDataset(df, "v", "y")) == pytest.approx(b.score(reg))
    assert [r["term"] for r in a.params(spark).collect()] == ["intercept", "v[0]", "v[1]", "v[2]", "v[3]"]


def test_empty_and_missing_label(reg):
    with pytest.raises(ValueError):
        LinearRegression().fit(reg.with_df(reg.df.limit(0)))
    with pytest.raises(ValueError):
        Ridge().fit(TabularDataset(reg.df, ["x0"]))


def test_names_are_available_on_the_package():
    import gramspan

    assert gramspan.Ridge is Ridge and gramspan.TabularDataset is TabularDataset
    with pytest.raises(AttributeError):
        gramspan.Nothing
