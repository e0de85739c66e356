import numpy as np
import pytest

from gramspan.plans import components


def plain_labels(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {x: root(x) for x in up}


@pytest.mark.parametrize("held", [1_000_000, 40, 6])
def test_components_whatever_a_task_holds(spark, monkeypatch, held):
    """One task, a few reductions, or star rounds: the labels are the same."""
    monkeypatch.setattr(components, "TASK_EDGES", held)
    rng = np.random.default_rng(held)
    edges = [(i, i + 1) for i in range(0, 90)] + [(500, 500 + i) for i in range(1, 60)]
    edges += [tuple(map(int, e)) for e in rng.integers(1000, 1150, (120, 2))] + [(7, 7), (-3, 10**15)]
    rng.shuffle(edges)
    df = spark.createDataFrame([tuple(map(int, e)) for e in edges], "u long, v long").repartition(4)
    got = {r["node"]: r["label"] for r in components.connected_components(df).collect()}
    assert got == plain_labels([e for e in edges if e[0] != e[1]])


def test_no_edges(spark):
    empty = spark.createDataFrame([], "u long, v long")
    assert components.connected_components(empty).count() == 0
    assert components.connected_components(spark.createDataFrame([(4, 4)], "u long, v long")).count() == 0
