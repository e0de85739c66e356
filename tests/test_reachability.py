import brute
import numpy as np
import pytest

from gramspan.operators import dbscan_sweep
from gramspan.operators import reachability
from gramspan.sources import from_rows


def plain_forest(a, b, w):
    """Weights of a minimum spanning forest, edge by edge."""
    up, out = {}, []

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for weight, x, y in sorted(zip(w, a, b)):
        x, y = root(x), root(y)
        if x != y:
            up[x] = y
            out.append(weight)
    return out


@pytest.mark.parametrize("ties", [False, True])
def test_spanning_forest(ties):
    rng = np.random.default_rng(3)
    for n, m in ((5, 4), (40, 30), (60, 400), (1, 3), (200, 5000)):
        a, b = rng.integers(0, n, m) * 7, rng.integers(0, n, m) * 7
        w = rng.integers(0, 4, m).astype(float) if ties else rng.random(m)
        got = reachability.spanning_forest(a, b, w)
        assert sorted(w[got]) == pytest.approx(plain_forest(a, b, w))
    assert len(reachability.spanning_forest(*(np.zeros(0, np.int64),) * 2, np.zeros(0))) == 0


GRID = [(0.2, 1), (0.35, 3), (0.6, 3), (0.6, 6), (0.9, 8), (2.5, 4)]


def scattered(d):
    rng = np.random.default_rng(d)
    centres = rng.normal(0, 3, (5, d))
    x = np.concatenate([c + rng.normal(0, 0.4, (30, d)) for c in centres] + [rng.normal(0, 4, (25, d))])
    x = np.round(x, 1)
    return np.concatenate([x, x[:20], [[np.nan] * d, [np.inf] * d]])


@pytest.mark.parametrize("edges", [500_000, 60])
@pytest.mark.parametrize("d, metric", [(1, "euclidean"), (2, "euclidean"), (2, "manhattan"), (6, "euclidean")])
def test_counts_equal_single_fits(spark, monkeypatch, d, metric, edges):
    monkeypatch.setattr(reachability, "TASK_EDGES", edges)
    x = scattered(d)
    ds = from_rows(spark, x.tolist())
    want = []
    for eps, m in GRID:
        label, core = brute.dbscan(x, eps, m, metric)
        want.append((eps, m, len(set(label[label >= 0])), int((label < 0).sum()), int(core.sum())))
    assert [tuple(r) for r in dbscan_sweep(ds, GRID, metric).collect()] == want


def test_sweep_edges(spark):
    ds = from_rows(spark, [[1.0, 2.0]])
    assert [tuple(r) for r in dbscan_sweep(ds, [(1, 1), (1, 2)]).collect()] == [(1.0, 1, 1, 0, 1), (1.0, 2, 0, 1, 0)]
    assert dbscan_sweep(ds, []).collect() == []
    odd = from_rows(spark, [[float("nan")], [float("inf")]])
    assert [tuple(r) for r in dbscan_sweep(odd, [(1, 1)]).collect()] == [(1.0, 1, 0, 2, 0)]
    with pytest.raises(ValueError):
        dbscan_sweep(ds, [(0, 1)])
    with pytest.raises(ValueError):
        dbscan_sweep(ds.with_df(ds.df.limit(0)), [(1, 1)])
