import brute
import numpy as np
import pytest

from gramspan.operators import SVC, LogisticRegression, c_sweep, kernel_sweep
from gramspan.operators import logistic as logistic_module
from gramspan.operators import svc as svc_module
from gramspan.operators.svc import Kernel
from gramspan.sources import from_rows

DOSES = [[0.5], [1], [1.5], [2.5], [3], [4], [4.5]]
CURED = [0, 0, 1, 0, 1, 1, 1]


@pytest.mark.parametrize("cells", [0, 1_000_000])
@pytest.mark.parametrize("intercept", [True, False])
def test_logistic_matches_plain_descent(spark, monkeypatch, cells, intercept):
    monkeypatch.setattr(logistic_module, "TASK_CELLS", cells)
    steps = 1000 if cells else 12
    ds = from_rows(spark, DOSES * 3, CURED * 3)
    m = LogisticRegression(max_iterations=steps, fit_intercept=intercept).fit(ds)
    want = brute.logistic_gd(DOSES * 3, CURED * 3, steps=steps, intercept=intercept)
    got = np.append(m.intercept, m.coefficients) if intercept else m.coefficients
    np.testing.assert_allclose(got, want, rtol=1e-9)


def test_logistic_descends_in_one_task(spark):
    """A fit of few merged rows is a fixed number of jobs, whatever the steps."""
    rng = np.random.default_rng(4)
    x = rng.normal(0, 2, (150, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(0, 1, 150) > 0.3).astype(float)
    ds = from_rows(spark, x.tolist(), y.tolist())
    spark.sparkContext.setJobGroup("descent", "one fit")
    m = LogisticRegression(max_iterations=300).fit(ds)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("descent"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    want = brute.logistic_gd(x, y, steps=300)
    np.testing.assert_allclose([m.intercept, *m.coefficients], want, rtol=1e-9)
    assert jobs <= 8


@pytest.mark.parametrize("cells", [0, 1_000_000])
def test_logistic_divergence_is_an_error(spark, monkeypatch, cells):
    monkeypatch.setattr(logistic_module, "TASK_CELLS", cells)
    with pytest.raises(ValueError, match="diverged"):
        LogisticRegression(learning_rate=1e308).fit(from_rows(spark, [[1e300], [1e300], [-1e300]], [1, 0, 0]))


def test_logistic_early_stop(spark):
    ds = from_rows(spark, [[0.0], [0.0]], [0, 1])
    m = LogisticRegression().fit(ds)
    assert m.n_iter < 20 and m.coefficients == pytest.approx([0.0])


def test_logistic_outputs(spark):
    ds = from_rows(spark, [[1], [2], [3], [4]], [0, 0, 1, 1])
    m = LogisticRegression(learning_rate=0.1).fit(ds)
    rows = m.transform(ds.df).orderBy("row_idx").collect()
    p = [r["probability"] for r in rows]
    assert p == sorted(p) and p[0] < 0.5 < p[3]
    assert [r["prediction"] for r in rows] == [float(v >= 0.5) for v in p]
    assert m.score(ds) >= 0.75
    assert m.loss(ds) == pytest.approx(m.evaluate(ds).head()["log_loss"])
    half = logistic_module.LogisticModel(ds.features, np.zeros(1), 0.0, 0)
    assert {r["prediction"] for r in half.predict(ds.df).collect()} == {1.0}


def test_logistic_mle(spark):
    x, y = DOSES, [0, 1, 0, 1, 0, 1, 1]
    m = LogisticRegression(solver="mle").fit(from_rows(spark, x, y))
    want = brute.logistic_gd(x, y, lr=0.1, steps=200_000, tol=0)
    np.testing.assert_allclose([m.intercept, *m.coefficients], want, rtol=1e-3)


def test_logistic_errors(spark):
    for y in ([0.5, 2], [-1, 1]):
        with pytest.raises(ValueError):
            LogisticRegression().fit(from_rows(spark, [[1], [2]], y))
    ds = from_rows(spark, [[1]], [1])
    with pytest.raises(ValueError):
        LogisticRegression().fit(ds.with_df(ds.df.limit(0)))
    with pytest.raises(ValueError):
        LogisticRegression().fit(from_rows(spark, [[float("nan")]], [1]))


def test_svc_linear(spark):
    x = [[1, 1], [2, 3], [4, 2], [-1, -1], [-3, -2], [-2, -5]]
    ds = from_rows(spark, x, [1, 1, 1, -1, -1, -1])
    m = SVC(kernel="linear").fit(ds)
    assert m.score(ds) == 1.0 and m.n_support_vectors(ds) == 2
    assert m.weights == pytest.approx([0.5, 0.5]) and m.intercept == pytest.approx(0, abs=1e-6)
    zero = from_rows(spark, [[0, 0]]).df
    flat = svc_module.SVCModel(ds.features, m.kernel, 0.0, 0, 1e-3, weights=m.weights)
    assert flat.predict(zero).head()["prediction"] == 1.0


def test_svc_rbf_and_polynomial(spark):
    x = [[0, 1], [1, 1], [1, 0], [6, 7], [7, 6], [7, 7]]
    ds = from_rows(spark, x, [1, 1, 1, -1, -1, -1])
    assert SVC().fit(ds).score(ds) == 1.0
    ds = from_rows(spark, [[2, 1], [3, 3], [-1, -2], [-3, -3]], [1, 1, -1, -1])
    assert SVC(kernel="polynomial", degree=2).fit(ds).score(ds) >= 0.5
    assert SVC(kernel="sigmoid", gamma=0.1).fit(ds).score(ds) >= 0.5


def noisy_ring(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (160, 2))
    y = np.where(np.hypot(*x.T) + rng.normal(0, 0.2, 160) > 1.1, 1.0, -1.0)
    # Copies become weighted rows.
    return from_rows(spark, np.concatenate([x, x[:90], x[:90]]).tolist(), [*y, *y[:90], *y[:90]])


def scores(model, ds):
    return np.array([r["score"] for r in model.decision_function(ds.df).orderBy("row_idx").collect()])


def test_svc_solvers_reach_the_same_optimum(spark, monkeypatch):
    ds = noisy_ring(spark)
    small = SVC().fit(ds)
    want = scores(small, ds)
    assert 0.85 < small.score(ds) < 1.0
    monkeypatch.setattr(svc_module, "WORKING_SET", 48)
    monkeypatch.setattr(svc_module, "SUPPORT_CHUNK", 40)
    big = SVC().fit(ds)
    assert big.support is not None
    np.testing.assert_allclose(scores(big, ds), want, atol=5e-3)


def test_svc_explicit_map_equals_kernel(spark):
    k = Kernel("polynomial", 0.7, 3, 1.5)
    rng = np.random.default_rng(1)
    a = rng.normal(size=(5, 2))
    ds = from_rows(spark, a.tolist())
    powers = svc_module._map_powers(k, 2)
    from pyspark.sql import functions as F

    z = ds.df.orderBy("row_idx").select(
        F.array(*svc_module._map_columns(k, powers, ds.features.columns()))
    ).collect()
    z = np.array([r[0] for r in z])
    np.testing.assert_allclose(z @ z.T, k.block(a, a))


def test_svc_primal_is_close_to_the_dual(spark, monkeypatch):
    ds = noisy_ring(spark)
    params = dict(kernel="polynomial", degree=2, coef0=1.0)
    want = SVC(**params).fit(ds)
    monkeypatch.setattr(svc_module, "WORKING_SET", 8)
    got = SVC(**params, max_iter=60).fit(ds)
    assert got.weights is not None and abs(got.score(ds) - want.score(ds)) < 0.03


def test_svc_nystrom_with_all_landmarks_is_exact(spark):
    ds = noisy_ring(spark)
    want = scores(SVC().fit(ds), ds)
    got = scores(SVC(approximation="nystrom", landmarks=400).fit(ds), ds)
    assert np.mean(np.sign(got) == np.sign(want)) > 0.97


def test_kernels():
    a, b = np.array([[1.0, 2.0]]), np.array([[3.0, 4.0]])
    assert Kernel("linear").block(a, b)[0, 0] == 11.0
    assert Kernel("polynomial", 1.0, 2, 1.0).block(a, b)[0, 0] == 144.0
    assert Kernel("rbf", 1.0).block(a, b)[0, 0] == pytest.approx(np.exp(-8.0))
    assert Kernel("sigmoid", 0.1, 3, 0.5).block(a, b)[0, 0] == pytest.approx(np.tanh(1.6))


def test_svc_sweeps(spark):
    x = [[1, 2], [2, 1], [3, 5], [5, 4], [-1, -2], [-2, -1], [-4, -3], [-5, -5], [3, -2], [-3, 2]]
    ds = from_rows(spark, x, [1, 1, 1, 1, -1, -1, -1, -1, 1, -1])
    got = c_sweep(ds, ds, [0.1, 10.0], kernel="linear").collect()
    assert [r["model"] for r in got] == ["C=0.1", "C=10"]
    assert all(r["n_support"] >= 2 for r in got)
    assert kernel_sweep(ds, ds, ["linear", "rbf"]).count() == 2


def test_svc_errors(spark):
    for y in ([0, 2], [1, 1], [-1, 2]):
        with pytest.raises(ValueError):
            SVC().fit(from_rows(spark, [[1], [2]], y))
    for bad in (dict(c=0), dict(c=-1), dict(gamma=0), dict(gamma=-1.0), dict(kernel="cubic")):
        with pytest.raises(ValueError):
            SVC(**bad)
    ds = from_rows(spark, [[1], [2]], [1, -1])
    with pytest.raises(ValueError):
        SVC().fit(ds.with_df(ds.df.limit(0)))
    with pytest.raises(ValueError):
        SVC().fit(ds).predict(ds.df.drop("x0"))
