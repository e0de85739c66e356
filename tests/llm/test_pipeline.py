"""The pipeline's stages, each against a plain version on its own input."""

from collections import Counter

import pyarrow.dataset as ds
import pytest

import corpus_pipeline
import plain
from gramspan.llm.common import stored


def test_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(stored(stage(spark, steps[-1], folder), "test"))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert steps[-1].columns == docs.columns
    rows = [{r["doc_id"]: r for r in s.collect()} for s in steps]
    labels = {r["doc_id"]: r["quality"] for r in ds.dataset(f"{folder}/labels.parquet").to_table().to_pylist()}
    bench = [b["text"] for b in ds.dataset(f"{folder}/benchmark.parquet").to_table().to_pylist()]

    good = [d for d in rows[0] if labels.get(d) == 1]
    assert sum(d in rows[1] for d in good) >= 0.95 * len(good)
    bad = [d for d in rows[0] if labels.get(d) == 0]
    assert sum(d in rows[1] for d in bad) <= 0.1 * len(bad)

    gone = plain.dropped_lines([(d, r["text"]) for d, r in rows[1].items()], 10)
    for d, r in rows[1].items():
        kept = "\n".join(x for i, x in enumerate(r["text"].split("\n")) if (d, i) not in gone)
        assert rows[2][d]["text"] == kept and rows[2][d]["n_chars"] == len(kept)

    groups = plain.components([(d, r["text"]) for d, r in rows[2].items()], 5, 80)
    assert set(rows[3]) == {d for d, (_, c) in groups.items() if c == d}

    leaking = {d for d, r in rows[3].items() if any(b in r["text"] for b in bench)}
    assert set(rows[4]) == set(rows[3]) - leaking

    size = {d: len(plain.words(r["text"])) for d, r in rows[4].items()}
    mix = steps[5].collect()
    taken, targets, copies = Counter(), {}, Counter()
    for r in mix:
        assert r["size"] == size[r["doc_id"]] and 1 <= r["copy"] <= r["repeats"] <= 2
        assert r["text"] == rows[4][r["doc_id"]]["text"]
        taken[r["source"]] += r["size"]
        targets[r["source"]] = r["target"]
        copies[r["doc_id"]] += 1
    assert all(copies[r["doc_id"]] == r["repeats"] for r in mix)
    longest = max(size.values())
    assert all(abs(taken[s] - targets[s]) <= longest for s in targets)
    assert sum(targets.values()) == pytest.approx(1.5 * sum(size.values()), rel=1e-3)


def test_stages_on_odd_tables(spark, corpus, tmp_path):
    """Null ids and texts, repeated rows, a very long text, other columns, and no rows at all."""
    bench = [(0, "alpha beta gamma delta " * 8), (1, None)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    odd = corpus[:25] + corpus[:2] + [(None, "no id " * 20), (None, None), (7, "other text of 7"), (500, "long text. " * 40_000)]
    for df in (plain.table(spark, odd), plain.table(spark, odd).limit(0)):
        docs = df
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)), "odd")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == df.columns
        assert docs.count() <= 2 * df.count()
