import numpy as np
import pytest

from gramspan.operators import LDA, PCA, TruncatedSVD, reconstruction_comparison
from gramspan.sources import TabularDataset, from_rows

_RNG = np.random.default_rng(11)
# Three groups in eight columns, four of them mixtures of the others and noise.
GROUPS = np.repeat([0, 1, 2], [9, 7, 6])
_BASE = _RNG.normal(0, 1, (22, 4)) + GROUPS[:, None] * [4.0, -3.0, 2.0, 6.0]
TABLE = np.column_stack([_BASE, _BASE @ _RNG.normal(0, 1, (4, 4)) + _RNG.normal(0, 0.1, (22, 4))])


def column(df, name):
    return np.array([r[name] for r in df.orderBy("row_idx").collect()])


def test_pca_matches_svd_of_centred_data(spark):
    ds = from_rows(spark, TABLE.tolist())
    m = PCA(2).fit(ds)
    c = TABLE - TABLE.mean(axis=0)
    s = np.linalg.svd(c, compute_uv=False)
    np.testing.assert_allclose(m.explained_variance, s[:2] ** 2 / 21)
    np.testing.assert_allclose(m.components @ m.components.T, np.eye(2), atol=1e-10)
    assert (m.components.sum(axis=1) > 0).all()
    z = column(m.transform(ds.df), "projected")
    np.testing.assert_allclose(z, c @ m.components.T, atol=1e-9)
    back = column(m.inverse_transform(m.transform(ds.df)), "reconstructed")
    assert m.score(ds) == pytest.approx(-((back - TABLE) ** 2).mean())
    assert m.explained_variance_ratio.sum() == pytest.approx(1.0)
    assert m.total_variance_ratio.sum() < 1.0
    np.testing.assert_allclose(m.get_covariance(), np.cov(TABLE.T))


def test_pca_full_rank_reconstructs_even_with_equal_eigenvalues(spark):
    x = [[1, 0], [-1, 0], [0, 1], [0, -1]]
    ds = from_rows(spark, x)
    m = PCA().fit(ds)
    back = column(m.inverse_transform(m.transform(ds.df)), "reconstructed")
    np.testing.assert_allclose(back, x, atol=1e-10)


def test_pca_few_rows_and_rank_one(spark):
    ds = from_rows(spark, [[2, -1, 5], [4, -2, 10], [7, -3.5, 17.5]])
    m = PCA(2).fit(ds)
    assert m.explained_variance_ratio[0] > 0.9
    wide = from_rows(spark, [[5, 1, 0, 2], [-1, 4, 7, 3]])
    assert PCA().fit(wide).components.shape == (2, 4)
    flat = PCA(1).fit(from_rows(spark, [[1, 1], [1, 1]]))
    assert flat.explained_variance_ratio.tolist() == [0.0]


def test_svd_matches_numpy(spark):
    ds = from_rows(spark, TABLE.tolist())
    m = TruncatedSVD(2).fit(ds)
    _, s, vt = np.linalg.svd(TABLE, full_matrices=False)
    np.testing.assert_allclose(m.singular_values, s[:2])
    np.testing.assert_allclose(np.abs(m.components), np.abs(vt[:2]), atol=1e-9)
    np.testing.assert_allclose(m.explained_variance, s[:2] ** 2 / 21)
    z = column(m.transform(ds.df), "projected")
    np.testing.assert_allclose(z, TABLE @ m.components.T, atol=1e-9)


def test_svd_identity_and_signs_with_few_rows(spark):
    ds = from_rows(spark, np.eye(3).tolist())
    m = TruncatedSVD(3).fit(ds)
    back = column(m.inverse_transform(m.transform(ds.df)), "reconstructed")
    np.testing.assert_allclose(back, np.eye(3), atol=1e-10)
    x = np.array([[1.0, -5.0, 2.0], [0.5, -4.0, 1.0]])
    m = TruncatedSVD(1).fit(from_rows(spark, x.tolist()))
    assert m.components[0] @ x.sum(axis=0) > 0
    one = TruncatedSVD(1).fit(from_rows(spark, [[3.0, 4.0]]))
    assert one.singular_values == pytest.approx([5.0]) and np.isinf(one.explained_variance[0])


@pytest.mark.parametrize("make", [PCA, TruncatedSVD])
def test_component_count_errors(spark, make):
    ds = from_rows(spark, [[3, 1, 2], [0, 6, 5]])
    for k in (0, 3):
        with pytest.raises(ValueError):
            make(k).fit(ds)
    with pytest.raises(ValueError):
        make(1).fit(ds.with_df(ds.df.limit(0)))
    with pytest.raises(ValueError):
        make(1).fit(ds).transform(ds.df.drop("x0"))


def test_lda_two_classes(spark):
    x = [[0.5, 1], [1.5, 2.5], [2.5, 1.5], [5.5, 7], [7, 6.5], [8.5, 9]]
    ds = from_rows(spark, x, [0, 0, 0, 1, 1, 1])
    m = LDA().fit(ds)
    assert m.components.shape == (1, 2) and m.components.sum() > 0
    assert np.linalg.norm(m.components[0]) == pytest.approx(1.0)
    assert m.score(ds) == 1.0
    a, c = np.array(x[:3], float), np.array(x[3:], float)
    sw = 3 * np.cov(a.T, ddof=0) + 3 * np.cov(c.T, ddof=0)
    v = np.linalg.solve(sw, c.mean(axis=0) - a.mean(axis=0))
    v *= np.sign(v.sum()) / np.linalg.norm(v)
    np.testing.assert_allclose(m.components[0], v, rtol=1e-5)


def test_lda_three_classes_and_caps(spark):
    ds = from_rows(spark, TABLE.tolist(), GROUPS.tolist())
    m = LDA().fit(ds)
    assert m.components.shape == (2, 8) and m.classes == (0.0, 1.0, 2.0)
    assert m.score(ds) > 0.5 and m.explained_variance_ratio.sum() == pytest.approx(1.0)
    capped = LDA(5).fit(from_rows(spark, [[0, 2, 4], [1, 4, 3], [6, 5, 0], [8, 7, 1]], [0, 0, 1, 1]))
    assert len(capped.components) == 1
    assert column(capped.transform(from_rows(spark, [[1, 1, 1]]).df), "projected").shape == (1, 1)


def test_lda_errors(spark):
    with pytest.raises(ValueError):
        LDA().fit(from_rows(spark, [[1], [2]], [1, 1]))
    with pytest.raises(ValueError):
        LDA(0).fit(from_rows(spark, [[1], [2]], [0, 1]))
    with pytest.raises(ValueError, match="no direction"):
        LDA().fit(from_rows(spark, [[1], [2], [1], [2]], [0, 0, 1, 1]))


def test_reconstruction_comparison(spark):
    ds = from_rows(spark, TABLE.tolist())
    rows = {(r["method"], r["k"]): r["mse"] for r in reconstruction_comparison(ds, [1, 2, 3]).collect()}
    for k in (1, 2, 3):
        assert rows["pca", k] == pytest.approx(-PCA(k).fit(ds).score(ds), abs=1e-9)
        assert rows["svd", k] == pytest.approx(-TruncatedSVD(k).fit(ds).score(ds), abs=1e-9)


def wide_data(n, d, seed=3):
    """Rows with a few strong directions, some close to each other, and noise in all columns."""
    rng = np.random.default_rng(seed)
    strength = np.array([9.0, 7.0, 6.9, 3.0, 2.0, 1.9])
    basis = np.linalg.qr(rng.normal(size=(d, len(strength))))[0]
    return rng.normal(size=(n, len(strength))) * strength @ basis.T + rng.normal(0, 0.2, (n, d)) + rng.normal(0, 2, d)


def vectors_of(spark, x):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(x.tolist())], "row_idx long, v array<double>")
    return TabularDataset(df.repartition(4), "v", order_by=["row_idx"])


@pytest.mark.parametrize("n, d", [(400, 200), (60, 200), (30, 7)])
def test_subspace_solver_equals_the_dense_one(spark, n, d):
    ds = vectors_of(spark, wide_data(n, d))
    got, want = PCA(5, solver="subspace").fit(ds), PCA(5).fit(ds)
    np.testing.assert_allclose(got.explained_variance, want.explained_variance, rtol=1e-8)
    np.testing.assert_allclose(got.components, want.components, atol=1e-6)
    np.testing.assert_allclose(got.mean, want.mean)
    np.testing.assert_allclose(got.total_variance_ratio, want.total_variance_ratio, rtol=1e-8)
    got, want = TruncatedSVD(4, solver="subspace").fit(ds), TruncatedSVD(4).fit(ds)
    np.testing.assert_allclose(got.singular_values, want.singular_values, rtol=1e-8)
    np.testing.assert_allclose(got.components, want.components, atol=1e-6)


def test_subspace_solver_of_many_columns(spark):
    """A matrix of d x d numbers would take 200 MB here."""
    d = 5000
    x = wide_data(90, d, 8)
    got = PCA(3, solver="subspace").fit(vectors_of(spark, x))
    c = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    np.testing.assert_allclose(got.explained_variance, s[:3] ** 2 / 89, rtol=1e-7)
    np.testing.assert_allclose(np.abs((got.components * vt[:3]).sum(axis=1)), 1.0, atol=1e-6)


def test_subspace_solver_edges(spark):
    flat = vectors_of(spark, np.ones((6, 4)))
    assert PCA(2, solver="subspace").fit(flat).explained_variance.tolist() == [0.0, 0.0]
    assert PCA(2, solver="subspace").fit(flat).get_covariance() is None
    for bad in (lambda: PCA(solver="subspace"), lambda: PCA(2, solver="qr"), lambda: PCA(9, solver="subspace").fit(flat)):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(ValueError):
        PCA(1, solver="subspace").fit(flat.with_df(flat.df.limit(0)))
    nulls = spark.createDataFrame([(1, [1.0, None]), (2, [1.0, 2.0])], "row_idx long, v array<double>")
    with pytest.raises(Exception, match="null"):
        PCA(1, solver="subspace").fit(TabularDataset(nulls, "v", order_by=["row_idx"]))
