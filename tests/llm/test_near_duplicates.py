"""The n-gram join where many sets share keys: common passages, large groups, small blocks."""

import random

import numpy as np
import pytest

import plain
from plain import table

from gramspan.llm import jaccard


def prose(r, n):
    return " ".join(f"w{r.randrange(10**7)}" for _ in range(n))


def changed(r, text, n):
    words = text.split(" ")
    for at in r.sample(range(len(words)), n):
        words[at] = f"x{r.randrange(10**7)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def crowded():
    """Unlinked texts with a passage in common, a chain of near copies, a group around each of three texts."""
    r = random.Random(12)
    passage = prose(r, 60)
    rows = [(i, prose(r, 90) + " " + passage + " " + prose(r, r.randint(20, 90))) for i in range(400)]
    text = prose(r, 300)
    for i in range(400, 440):
        rows.append((i, text))
        text = changed(r, text, 4)
    for group in range(3):
        base = prose(r, 150) + " " + passage
        rows += [(1000 * (group + 1) + i, changed(r, base, r.randint(0, 9))) for i in range(60)]
    rows += [(9000 + i, rows[i][1]) for i in range(30)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("most, counted", [(2_000, 1 << 20), (9, 50)])
def test_crowded_keys(spark, crowded, monkeypatch, most, counted):
    monkeypatch.setattr(jaccard, "COUNTED", counted)
    got = jaccard.near_duplicates(table(spark, crowded).repartition(4), jaccard.Similarity(5, 80), most)
    want = plain.components(crowded, 5, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == want
    assert len({c for d, (_, c) in want.items() if d < 400}) == 400


def test_texts_of_one_document_tie_their_groups(spark):
    r = random.Random(3)
    a, b, c = (prose(r, 60) for _ in range(3))
    rows = [(5, a), (5, b), (6, a), (7, b), (3, b), (None, c), (None, a), (9, None), (9, c)]
    got = jaccard.near_duplicates(table(spark, rows), jaccard.Similarity(4, 85)).collect()
    assert sorted(((x["doc_id"], x["component_id"]) for x in got), key=str) == sorted(
        [(5, 3), (5, 3), (6, 3), (7, 3), (3, 3), (None, 9), (None, 3), (9, 9), (9, 9)], key=str
    )


@pytest.mark.parametrize("counted", [1 << 20, 4])
@pytest.mark.parametrize("batch", [1, 7, 1000])
def test_rows_of_shared_keys(spark, monkeypatch, counted, batch):
    monkeypatch.setattr(jaccard, "COUNTED", counted)
    r = random.Random(batch)
    rows = [(r.choice([1, 1, 2, 3, 4, *range(20, 60)]), r.randrange(12), 5) for _ in range(150)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(rows, "k long, a long, tag long").repartition(3)
        got = sorted(tuple(x) for x in jaccard._shared(df).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    members = {}
    for k, a, _ in rows:
        members.setdefault(k, set()).add(a)
    assert got == sorted((k, a, 5, min(len(m), counted)) for k, m in members.items() if len(m) > 1 for a in m)


def test_linked_sets_keep_a_rare_key():
    """Without its most frequent keys, one less than it must share, a set still shares one."""
    rng = np.random.default_rng(5)
    sim = jaccard.Similarity(5, 80)
    for n in (*range(5, 40, 3), 120, 700):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for _ in range(12):
            b = a[np.sort(rng.permutation(len(a))[int(rng.integers(0, n // 5 + 1)) :])]
            b = np.unique(np.append(b, rng.integers(0, 1 << 63, int(rng.integers(0, n // 9 + 2))).astype(np.uint64)))
            common = len(np.intersect1d(a, b))
            if common == len(a) == len(b) or not sim.linked(common, len(a), len(b)):
                continue
            s = jaccard.Sets.__new__(jaccard.Sets)
            s.grams, s.owner = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)])
            s.size, s.first = np.array([len(a), len(b)]), np.array([0, len(a)])
            keys, sets, tags = s.shared_keys(sim, np.ones(2, bool))
            often = {k: int(rng.integers(1, 50)) for k in keys.tolist()}
            kept = []
            for side in (0, 1):
                mine = set()
                for step in (0, 1):
                    at = np.flatnonzero((sets == side) & (tags % 2 == step))
                    order = sorted(at, key=lambda i: (-often[int(keys[i])], int(keys[i])))
                    mine |= {int(keys[i]) for r, i in enumerate(order, 1) if r >= tags[i] // 2}
                kept.append(mine)
            assert kept[0] & kept[1]
