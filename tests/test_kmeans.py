import brute
import numpy as np
import pytest

from gramspan.operators import KMeans, cluster_sizes, kmeans_sweep
from gramspan.operators import kmeans as module
from gramspan.sources import TabularDataset, from_rows

KM_7 = [[1, 2], [1.5, 1.8], [5, 8], [8, 8], [1, 0.6], [9, 11], [8, 2]]


def labels(df):
    return [int(r["cluster"]) for r in df.orderBy("row_idx").collect()]


@pytest.mark.parametrize("k", [1, 2, 3])
def test_matches_plain_lloyd(spark, k):
    ds = from_rows(spark, KM_7)
    m = KMeans(k).fit(ds)
    centers, label, inertia = brute.kmeans(KM_7, brute.seed_plus_plus(KM_7, k))
    np.testing.assert_allclose(m.centers, centers)
    assert labels(m.label(ds.df)) == label.tolist()
    assert m.inertia == pytest.approx(inertia)
    assert sum(m.counts) == 7


@pytest.mark.parametrize("state", [0, 7, 2**63, 2**64 - 2**40, 9_100_000_000_000_000_000])
def test_seeding_for_any_state(spark, monkeypatch, state):
    monkeypatch.setattr(module, "_FAN_OUT", 4)
    rng = np.random.default_rng(2)
    x = rng.normal(0, 3, (60, 2)).round(3)
    m = KMeans(4, random_state=state, max_iter=0).fit(from_rows(spark, x.tolist()))
    np.testing.assert_allclose(m.centers, brute.seed_plus_plus(x, 4, state))


def test_random_init_and_identical_rows(spark):
    m = KMeans(3, init="random", max_iter=0).fit(from_rows(spark, KM_7))
    np.testing.assert_allclose(m.centers, np.array(KM_7)[[(17 * k + 42) % 7 for k in range(3)]])
    same = from_rows(spark, [[1.0, 1.0]] * 5)
    m = KMeans(2).fit(same)
    assert m.inertia == 0.0 and labels(m.label(same.df)) == [0] * 5
    # The cluster that got no row keeps its centre.
    np.testing.assert_allclose(m.centers, [[1, 1], [1, 1]])


def test_predict_transform_and_sizes(spark):
    ds = from_rows(spark, [[1, 1], [1.2, 1], [9, 9], [9.1, 9]])
    m = KMeans(2).fit(ds)
    new = from_rows(spark, [[0, 0], [10, 10]]).df
    a, b = labels(m.predict(new))
    assert a != b
    dist = np.array([r["distances"] for r in m.transform(ds.df).orderBy("row_idx").collect()])
    assert dist.shape == (4, 2) and (dist >= 0).all()
    got = {r["cluster"]: r["size"] for r in m.sizes(spark).collect()}
    assert got == {r["cluster"]: r["size"] for r in cluster_sizes(m.label(ds.df)).collect()}
    with pytest.raises(ValueError):
        m.predict(new.drop("x1"))


def test_order_and_partitions_do_not_matter(spark):
    ds = from_rows(spark, KM_7)
    a = KMeans(3).fit(ds)
    b = KMeans(3).fit(ds.with_df(ds.df.orderBy("x1").repartition(5)))
    np.testing.assert_allclose(a.centers, b.centers)


def test_ties_and_nan_go_to_the_lowest_index(spark):
    m = KMeans(2, max_iter=1).fit(from_rows(spark, [[0.0], [2.0]]))
    new = from_rows(spark, [[1.0], [float("nan")]]).df
    assert labels(m.predict(new)) == [0, 0]


def test_parallel_backend(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 0.1, (40, 2)) for c in (0, 5, 10)])
    m = KMeans(3, backend="mllib", random_state=1).fit(from_rows(spark, x.tolist()))
    assert sorted(np.round(m.centers.mean(axis=1)).tolist()) == [0, 5, 10]


def test_sweep_and_errors(spark):
    ds = from_rows(spark, KM_7)
    rows = kmeans_sweep(ds, [1, 2, 3]).orderBy("k").collect()
    inertia = [r["inertia"] for r in rows]
    assert inertia == sorted(inertia, reverse=True)
    for bad in (lambda: KMeans(0), lambda: KMeans(2, init="nope"), lambda: KMeans(2, backend="x")):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(ValueError):
        KMeans(8).fit(ds)
    with pytest.raises(ValueError):
        KMeans(1).fit(ds.with_df(ds.df.limit(0)))
    with pytest.raises(ValueError):
        KMeans(1).fit(TabularDataset(ds.df, ["x0"]))
