import brute
import numpy as np
import pytest

from gramspan.operators import dbscan as module
from gramspan.operators.dbscan import DBSCAN, dbscan_sweep, region_query
from gramspan.plans import components, neighbours, skew
from gramspan.sources import TabularDataset, from_rows


def run(spark, x, eps, min_samples, metric="euclidean"):
    model = DBSCAN(eps, min_samples, metric).fit(from_rows(spark, x))
    rows = model.labels.orderBy("row_idx").collect()
    return [int(r["cluster"]) for r in rows], [r["is_core"] for r in rows], model


def check(spark, x, eps, min_samples, metric="euclidean"):
    labels, core, model = run(spark, x, eps, min_samples, metric)
    want, want_core = brute.dbscan(x, eps, min_samples, metric)
    assert labels == want.tolist()
    assert core == want_core.tolist()
    return model


def test_two_groups_and_an_outlier(spark):
    x = [[0, 3], [0.4, 3.3], [0.7, 2.8], [6, 1], [6.5, 1.4], [6.2, 0.6], [3, 9]]
    model = check(spark, x, 1.0, 2)
    assert model.get_n_noise_points() == brute.dbscan(x, 1.0, 2)[0].tolist().count(-1)


def test_all_noise_and_one_cluster(spark):
    labels, _, model = run(spark, [[0, 5], [7, 0], [15, 4], [-9, 8]], 1.0, 2)
    assert labels == [-1] * 4 and model.get_n_clusters() == 0
    dense = [[2.0, 1], [2.2, 1.1], [1.9, 1.2], [2.1, 0.8], [2.05, 1.05]]
    assert run(spark, dense, 0.5, 3)[0] == [0] * 5


def test_exact_radius_is_inclusive_and_manhattan(spark):
    check(spark, [[0.0], [1.0], [2.0], [4.0]], 1.0, 2)
    check(spark, [[0, 0], [0.5, 1], [2, 1], [2, 3.5]], 1.5, 2, "manhattan")
    check(spark, [[0, 0], [1, 1], [2, 0], [5, 5]], 2.0, 2, "manhattan")


def test_border_row_takes_the_lowest_cluster(spark):
    # Row 0 lies between two dense groups and is core in neither.
    x = [[0, 0], [3, 0], [3.2, 0], [3.4, 0], [1.0, 0], [-1.0, 0], [-3, 0], [-3.2, 0], [-3.4, 0]]
    check(spark, x, 2.2, 4)
    check(spark, x, 2.0, 4)


@pytest.mark.parametrize(
    "d,metric", [(1, "euclidean"), (2, "manhattan"), (2, "euclidean"), (3, "euclidean")]
)
def test_random_points_match_brute_force(spark, d, metric):
    rng = np.random.default_rng(d)
    x = np.concatenate(
        [rng.normal(0, 1, (150, d)), rng.normal(4, 0.2, (80, d)), rng.uniform(-3, 8, (60, d))]
    )
    x = np.concatenate([x, x[:30], np.repeat(x[200:201], 40, axis=0)]).round(2)
    rng.shuffle(x)
    check(spark, x, [0.05, 0.35, 0.7][d - 1], [6, 5, 6][d - 1], metric)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_high_dimension_matches_brute_force(spark, metric, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 60)
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(c, 0.4, (60, 6)) for c in (0, 1.2, 3)])
    x = np.concatenate([x, np.repeat(x[:1], 70, axis=0)])
    check(spark, x, 1.0 if metric == "euclidean" else 2.2, 5, metric)


def test_crowded_cells_are_refined(spark, monkeypatch):
    # Two parallel strips just inside or just outside the radius.
    monkeypatch.setattr(module, "DIRECT_PAIRS", 4)
    rng = np.random.default_rng(3)
    t = rng.uniform(0, 1, 120)
    for gap in (0.9999, 1.0001):
        x = np.concatenate([np.column_stack([t, 0 * t]), np.column_stack([t, 0 * t + gap])])
        check(spark, x, 1.0, 5)


def test_distributed_paths_match(spark, monkeypatch):
    monkeypatch.setattr(skew, "MIN_ROWS", 0)
    monkeypatch.setattr(skew, "HOT_SHARE", 10)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 0.05, (120, 2)), rng.uniform(-2, 2, (80, 2))])
    check(spark, np.concatenate([x, np.zeros((60, 2))]), 0.25, 4)


def test_non_finite_rows_are_noise(spark):
    x = [[0, 0], [0.1, 0], [0, 0.1], [float("nan"), 0], [float("inf"), 0]]
    labels, core, _ = run(spark, x, 1.0, 1)
    assert labels == [0, 0, 0, -1, -1] and core == [True] * 3 + [False] * 2


def test_sweep_and_errors(spark):
    x = [[0, 0], [0.3, 0.4], [0.9, 0.1], [4, 4], [4.7, 4.6], [9, 0]]
    ds = from_rows(spark, x)
    got = dbscan_sweep(ds, [(0.5, 2), (1.0, 2)]).orderBy("eps").collect()
    for r in got:
        label, core = brute.dbscan(x, r["eps"], r["min_samples"])
        assert (r["n_clusters"], r["n_noise"], r["n_core"]) == (
            label.max() + 1, (label == -1).sum(), core.sum()
        )
    for bad in (dict(eps=0, min_samples=2), dict(eps=1, min_samples=0), dict(eps=1, min_samples=2, metric="cosine")):
        with pytest.raises(ValueError):
            DBSCAN(**bad)
    with pytest.raises(ValueError):
        DBSCAN(1, 2).fit(ds.with_df(ds.df.limit(0)))
    with pytest.raises(ValueError):
        DBSCAN(1, 2).fit(TabularDataset(ds.df, ["x0", "x1"]))
    with pytest.raises(NotImplementedError):
        DBSCAN(1, 2).fit(ds).predict(ds.df)


def test_region_query(spark):
    ds = from_rows(spark, [[0, 0], [1, 0], [1, 1], [3, 3]])
    for metric, want in (("euclidean", [0, 1]), ("manhattan", [0, 1])):
        got = region_query(ds, [0, 0], 1.0, metric).collect()
        assert sorted(r["row_idx"] for r in got) == want
    with pytest.raises(ValueError):
        region_query(ds, [0.0], 1.0)


def test_component_rounds_on_a_long_chain(spark):
    rng = np.random.default_rng(1)
    perm = rng.permutation(200)
    pairs = [(int(perm[i]), int(perm[i + 1])) for i in range(199) if i != 120]
    out = components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    got = {r["node"]: r["label"] for r in out}
    for part in (perm[:121], perm[121:]):
        assert {got[int(v)] for v in part} == {int(part.min())}


def test_balls_part_clusters():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 20, (12, 8))
    x = np.concatenate([c + rng.normal(0, 0.3, (200, 8)) for c in centres])
    found = neighbours.ball_centres(x, 4.0)
    near = np.sqrt(((found[:, None, :] - centres[None]) ** 2).sum(axis=2)).min(axis=1)
    assert 12 <= len(found) <= neighbours.BALLS and (near < 2).mean() >= 0.8
    assert neighbours.ball_centres(np.zeros((5, 3)), 1e9).tolist() == [[0.0, 0.0, 0.0]]


@pytest.mark.parametrize("rows", [1024, 40])
def test_blocks_miss_no_pair_and_skip_most(spark, monkeypatch, rows):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", rows)
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 6, (15, 7))
    x = np.concatenate([c + rng.normal(0, 0.4, (30, 7)) for c in centres])
    data = [(i, 1, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(data, "id long, w long, x array<double>")
    blocks = neighbours.Blocks(df, 7, 1.2)
    block = {r["id"]: r["block"] for r in blocks.points.select("id", "block").collect()}
    pairs = {(r["a"], r["b"]) for r in blocks.pairs.collect()}
    assert len(block) == len(x)
    close = np.argwhere(brute.distances(x) <= 1.2)
    assert all(tuple(sorted((block[i], block[j]))) in pairs for i, j in close)
    n = len(set(block.values()))
    if rows == 40:
        assert n >= 12 and len(pairs) < 0.35 * n * (n + 1) / 2


def test_blocks_follow_the_number_of_points(spark):
    # No direction parts these points, but they fall into many balls and cells.
    x = np.random.default_rng(4).normal(0, 1, (3000, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "id long, w long, x array<double>")
    blocks = neighbours.Blocks(df, 12, 0.5)
    assert {r["block"] for r in blocks.points.select("block").collect()} == {0}
    assert [(r["a"], r["b"]) for r in blocks.pairs.collect()] == [(0, 0)]


@pytest.mark.parametrize("min_samples, eps", [(3, 0.9), (9, 0.7), (60, 0.9)])
def test_links_between_blocks(spark, monkeypatch, min_samples, eps):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 70)
    monkeypatch.setattr(module, "PROBES", 2)
    rng = np.random.default_rng(6)
    centres = [np.eye(5)[0] * c for c in (0, 1.2, 2.4, 9, 12)]
    x = np.concatenate([c + rng.normal(0, 0.25, (80, 5)) for c in centres] + [rng.uniform(-3, 12, (40, 5))])
    rng.shuffle(x)
    check(spark, x, eps, min_samples)


def test_only_open_points_meet_other_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 100)
    asked, across = [], neighbours.Blocks.across

    def counted(self, queries, *rest):
        asked.append(queries.count())
        return across(self, queries, *rest)

    monkeypatch.setattr(neighbours.Blocks, "across", counted)
    x = np.random.default_rng(8).normal(0, 1, (600, 6))
    check(spark, x, 2.0, 3)
    assert len(asked) >= 3 and sum(asked) < 0.5 * len(x)
