"""Operators against plain versions, on whole small tables and on edge cases."""

import base64
import hashlib
import io
import re

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
import zstandard
from pyspark.sql import functions as F

import plain
from plain import table

from gramspan.llm import (
    decontaminate,
    fingerprints,
    jaccard,
    licenses,
    lines,
    mixing,
    quality,
    queries,
    repeats,
    suffixes,
    warc,
)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.mark.parametrize("width, first", [(35, 18), (35, 9), (12, 12), (5, 2)])
def test_repeats(spark, corpus, width, first):
    got = repeats.remove_repeats(table(spark, corpus), width, first)
    assert rows_of(got, *got.columns) == sorted(plain.repeats(corpus, width), key=str)


def test_repeated_rows_and_null_ids(spark, corpus):
    odd = [*corpus[:30], *corpus[:3], (None, corpus[4][1]), (None, "short"), (7, "another text " * 30)]
    got = repeats.remove_repeats(table(spark, odd))
    assert rows_of(got, *got.columns) == sorted(plain.repeats(odd, 35), key=str)
    got = suffixes.remove_earlier_strings(table(spark, odd))
    assert rows_of(got, *got.columns) == sorted(plain.earlier_strings(odd, 50), key=str)


def test_documents_with_several_texts(spark):
    """Rows that share an id, or have none, count by their text."""
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(5, a), (5, b), (6, a), (7, b), (None, a), (None, b), (None, "c d"), (8, b[:200])]
    for some in (rows, rows[:4], rows[:2], [(5, a), (5, a + " more")]):
        got = repeats.remove_repeats(table(spark, some))
        assert rows_of(got, *got.columns) == sorted(plain.repeats(some, 35), key=str)


def test_candidates_fall_from_level_to_level():
    """Only windows around a repeated shorter window are looked at again."""
    rng = np.random.default_rng(3)
    text = lambda n: b" ".join(b"w%d" % i for i in rng.integers(0, 400, n))
    short, long = text(12), text(60)
    body = [text(200) + b" " + x + b" " + text(200) for x in (short, short, long, long)]
    assert repeats.levels(35, repeats.FIRST) == [9, 18, 35]
    x = repeats.Windows(body, 35)
    found, left, owners = None, [], []
    for length, before in ((9, None), (18, 9), (35, 18)):
        wanted = x.valid if before is None else x.surviving(before, found)
        left.append(int(wanted.sum()))
        owners.append(set(x.block.owner[: len(wanted)][wanted].tolist()))
        h, at = x.anchors(length, wanted)
        owner = x.block.owner[at]
        often = [v for v in set(h.tolist()) if (h == v).sum() > 1]
        found = [np.array([v for v in often if v in set(h[owner == i].tolist())], np.uint64) for i in range(4)]
    assert left[0] > 5 * left[1] > 0 and owners == [{0, 1, 2, 3}, {0, 1, 2, 3}, {2, 3}]
    # Around the long passage, the windows at the last level include all 26 inside it.
    assert 2 * 26 <= left[2] < left[1]


@pytest.mark.parametrize("hot", [5_000, 2])
def test_earlier_strings(spark, corpus, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 3_000)
    got = suffixes.remove_earlier_strings(table(spark, corpus))
    assert rows_of(got, *got.columns) == sorted(plain.earlier_strings(corpus, 50), key=str)


def test_bucket_sort_is_exact():
    rng = np.random.default_rng(2)
    contexts, lead, n, doc = [], [], [], []
    core = bytes(rng.integers(97, 99, 120, dtype=np.uint8))
    for i in range(80):
        a, m = int(rng.integers(0, 30)), int(rng.integers(1, 30))
        c = bytearray(core[a : a + m + 49])
        if i % 3 == 0:
            c[int(rng.integers(len(c)))] = 122
        contexts.append(bytes(c)), n.append(m), lead.append(40 - a), doc.append(i % 50)
    row, offset = suffixes.bucket_repeats(np.array(doc), np.array(lead), np.array(n), contexts)
    least = {}
    whole = [(d, c[o : o + 50], k - o) for d, c, k, m in zip(doc, contexts, lead, n) for o in range(m)]
    for d, s, k in whole:
        least[s, k] = min(least.get((s, k), d), d)
    want = {(i, o) for i in range(80) for o in range(n[i]) if least[contexts[i][o : o + 50], lead[i] - o] < doc[i]}
    assert set(zip(row.tolist(), offset.tolist())) == want and want


@pytest.mark.parametrize("words, percent, most", [(4, 85, 20_000), (5, 80, 2)])
def test_near_duplicates(spark, corpus, words, percent, most):
    got = jaccard.near_duplicates(table(spark, corpus), jaccard.Similarity(words, percent), most)
    want = plain.components(corpus, words, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == want
    assert sum(c != d for d, (_, c) in want.items()) > 10


def test_parts_find_every_pair():
    """Whatever tokens two linked sets differ in, some part is equal."""
    rng = np.random.default_rng(0)
    sim = jaccard.Similarity(4, 85)
    for n in (*range(6, 40), 100, 400):
        a = np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for _ in range(20):
            cut = int(rng.integers(0, max(1, int(n * 0.15)) + 1))
            b = a[np.sort(rng.permutation(n)[: n - cut])]
            extra = rng.integers(0, 1 << 63, int(rng.integers(0, 4))).astype(np.uint64)
            b = np.unique(np.concatenate([b, extra]))
            common = len(np.intersect1d(a, b))
            if len(a) == len(b) == common or not sim.linked(common, len(a), len(b)):
                continue
            s = jaccard.Sets.__new__(jaccard.Sets)
            s.grams, s.owner = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)])
            s.size, s.first = np.array([len(a), len(b)]), np.array([0, len(a)])
            keys, sets = s.part_keys(sim, np.ones(2, bool))
            assert set(keys[sets == 0]) & set(keys[sets == 1])


def test_signature_tree_links_what_brute_force_links():
    rng = np.random.default_rng(4)
    sim = jaccard.Similarity(5, 80)
    base = [rng.integers(0, 1 << 63, 60).astype(np.uint64) for _ in range(6)]
    sets = []
    for i in range(90):
        s = base[i % 6].copy()
        s[rng.permutation(60)[: int(rng.integers(0, 9))]] = rng.integers(0, 1 << 63)
        sets.append(np.unique(np.append(s, rng.integers(0, 1 << 63, int(rng.integers(0, 4))).astype(np.uint64))))
    up = list(range(90))
    root = lambda x: x if up[x] == x else root(up[x])
    for i in range(90):
        for j in range(i):
            if sim.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j])):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    assert jaccard.link_cluster(sets, sim).tolist() == [root(i) for i in range(90)]


@pytest.mark.parametrize("min_docs", [3, 10])
def test_lines(spark, corpus, min_docs):
    got = lines.drop_recurring_lines(table(spark, corpus), min_docs)
    gone = plain.dropped_lines(corpus, min_docs)
    want = []
    for doc, t in corpus:
        cut = [] if t is None else t.split("\n")
        kept = None if t is None else "\n".join(x for i, x in enumerate(cut) if (doc, i) not in gone)
        want.append((doc, len(cut), sum(d == doc for d, _ in gone), kept))
    assert rows_of(got, "doc_id", "n_lines", "n_removed", "text") == sorted(want, key=str)
    assert gone and set(table(spark, corpus[:1]).columns) <= set(got.columns)


@pytest.mark.parametrize("n", [200, 900, 5_000])
def test_lines_of_two_fields_at_any_size(spark, n):
    line = "Our branch in city{} offers today the best product{} at a very good price"
    rows = [(i, f"own{i} text{i}\n" + line.format("abcdefghijklmnopqrstuvwxyzABCD"[i % 30], "abcdefghijklmnopqrstuvwxyzABCD"[i // 30 % 30])) for i in range(n)]
    got = rows_of(lines.drop_recurring_lines(table(spark, rows)), "doc_id", "n_removed")
    assert sorted(got) == [(i, int(i > 0)) for i in range(n)]


def test_long_equal_lines(spark):
    """A passage of many words goes from the third document on; a shorter line and a changed one stay."""
    passage, short = " ".join(f"p{i}x" for i in range(55)), "a short line of seven words here"
    rows = [(i, f"own {i}\n{passage}\n{short}") for i in range(3)]
    rows += [(3, passage + " and"), (None, f"{passage}\nend"), (None, f"{passage}\nend"), (5, "\n".join([passage] * 2))]
    got = lines.drop_recurring_lines(table(spark, rows))
    assert rows_of(got, "doc_id", "n_removed") == sorted(
        [(0, 1), (1, 1), (2, 1), (3, 0), (None, 0), (None, 0), (5, 2)], key=str
    )
    two = lines.drop_recurring_lines(table(spark, rows[:2]))
    assert rows_of(two, "n_removed") == [(0,), (0,)]


def test_equal_lines_of_numbers(spark):
    rows = [(i, f"Tel 555 1234 5678\nTel 555 1234 {i:04d}\nown{i} text{i}") for i in range(12)]
    got = rows_of(lines.drop_recurring_lines(table(spark, rows)), "doc_id", "n_removed", "text")
    assert got == sorted(((i, int(i > 0), t if not i else t.split("\n", 1)[1]) for i, t in rows), key=str)


def test_quality_learns_without_negatives(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    rank, good = got["score"].rank(), got["quality"] == 1
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.95 and ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()
    # Labels of the held-out fold teach nothing.
    flip = F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    flipped = labels.withColumn("quality", flip)
    again = quality.classify(docs, flipped).toPandas().set_index("doc_id")["score"]
    assert np.allclose(again[got["doc_id"]], got["score"])


def test_quality_edges(spark, corpus):
    docs = table(spark, [*corpus[:20], (None, "text"), (None, None)])
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0), (3, 0), (999, 1)], "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == 22 and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    assert quality.classify(docs.limit(0), labels).count() == 0
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {round(r["score"], 6) for r in none} == {0.5}


def test_fingerprints(spark, corpus):
    distinct = dict(corpus)
    got = {r["doc_id"]: r for r in fingerprints.compare_with_next(table(spark, corpus)).collect()}
    order = sorted(distinct, reverse=True)
    roots = {}
    for k, doc in enumerate(order):
        t, nxt = distinct[doc] or "", distinct[order[(k + 1) % len(order)]] or ""
        half = len(t) // 2
        edited, r = t[: len(t) - half] + nxt[:half], got[doc]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), plain.sha(edited.encode()))
        roots.setdefault(t, r["fingerprint"]), roots.setdefault(edited, r["edited_fingerprint"])
        assert roots[t] == r["fingerprint"] and roots[edited] == r["edited_fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and (r["near_edited"] == 1) >= (t == edited)
        if t == edited:
            assert r["edit_section"] is None
        elif "\n\n" not in t and "\n\n" not in edited:
            a, b = t.splitlines(True), edited.splitlines(True)
            first = next(i for i in range(max(len(a), len(b))) if a[i : i + 1] != b[i : i + 1])
            assert (r["edit_section"], r["edit_paragraph"]) == (1, first + 1)
    assert len(set(roots.values())) == len(roots) and set(got) == set(order)
    assert fingerprints.compare_with_next(table(spark, corpus).limit(0)).count() == 0


def plain_leaves(text):
    """Leaves of a text's lines, word by word."""
    out = set()
    for line in re.findall(r"[^\n]*\n|[^\n]+", text):
        while line:
            ends = [m.end() for m in re.finditer(fingerprints.LEAF_ENDS, line) if 1 <= m.start() <= fingerprints.LEAF]
            rest = len(line.rstrip("\n"))
            end = ends[0] if ends else len(line) if rest <= fingerprints.LEAF else fingerprints.LEAF
            out.add(line[:end])
            line = line[end:]
    return out


def test_fingerprints_of_every_row(spark):
    """Rows that share an id or have none, equal rows, and likeness by leaves."""
    line = " ".join(f"word{i} eren{i}d and" for i in range(130))
    rows = [(9, line), (8, "x" + line), (5, "one of two\nnext"), (5, "other text"), (5, "other text"), (None, "a b"), (None, "c d"), (None, None)]
    got = fingerprints.compare_with_next(table(spark, rows).repartition(3)).collect()
    assert sorted(((r["doc_id"], r["n_chars"]) for r in got), key=str) == sorted(((d, len(t or "")) for d, t in rows), key=str)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    # A letter in front of a long line leaves all leaves but the first.
    assert by[9][0]["near_next"] > 0.95 and by[9][0]["fingerprint"] != by[8][0]["fingerprint"]
    a, b = plain_leaves(line), plain_leaves("x" + line)
    assert by[9][0]["near_next"] == pytest.approx(2 * len(a & b) / (len(a) + len(b)))
    twins = [r for r in by[5] if r["n_chars"] == 10]
    assert len(twins) == 2 and max(r["near_next"] for r in twins) == 1.0
    # Of the equal rows, one is edited with the other's beginning and one with the next text's.
    assert plain.sha(("other" + "other").encode()) in {r["edited_sha256"] for r in twins}
    assert len({r["fingerprint"] for r in got}) == 7
    alone = fingerprints.compare_with_next(table(spark, [(None, "abcd")])).collect()
    assert [(r["edited_sha256"], r["near_next"]) for r in alone] == [(plain.sha(b"abab"), 1.0)]


def test_fingerprints_shuffle_the_texts_once(spark, corpus):
    got = fingerprints.compare_with_next(table(spark, corpus))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("partial_min(text") == 1 and "ReusedExchange [bare" in plan


def test_mixing(spark, corpus):
    rows = [(d, t, None if i % 9 == 0 else f"s{i % 5}") for i, (d, t) in enumerate(corpus)]
    got = mixing.mix_sources(table(spark, rows)).collect()
    size = {d: len(plain.words(t)) for d, t, _ in rows}
    total = {}
    for d, _, s in rows:
        total[s] = total.get(s, 0) + size[d]
    taken, target = {}, {}
    for r in got:
        s = next(x[2] for x in rows if x[0] == r["doc_id"])
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[s] and r["taken"] <= 2 * r["size"]
        taken[s], target[s] = taken.get(s, 0) + r["taken"], r["target"]
        assert r["target"] <= 2 * total[s] + 1e-9
    assert sum(target.values()) == pytest.approx(1.5 * sum(total.values()))
    order = sorted(total, key=lambda s: (s is None, s or ""))
    free = [target[s] / (5, 2, 1)[i % 3] for i, s in enumerate(order) if target[s] < 2 * total[s] - 1e-6]
    assert np.allclose(free, free[0]) if free else True
    for s in total:
        assert abs(taken[s] - target[s]) <= max(size[d] for d, _, x in rows if x == s)
    again = mixing.mixed_documents(table(spark, rows)).collect()
    wanted = [(r["doc_id"], k, r["size"]) for r in got for k in range(1, r["repeats"] + 1)]
    assert sorted((r["doc_id"], r["copy"], r["size"]) for r in again) == sorted(wanted)
    assert mixing.mix_sources(table(spark, rows).limit(0)).count() == 0
    blank = mixing.mix_sources(table(spark, [(1, None), (2, "  "), (None, "")])).collect()
    assert {(r["target"], r["taken"]) for r in blank} == {(0.0, 0)}


def test_mixing_draws_rows_without_id_one_by_one(spark):
    rows = [(None, f"w{i} " * 30, "a") for i in range(10)] + [(7, f"v{i} " * 30, "b") for i in range(40)]
    got = mixing.mix_sources(table(spark, rows), total_ratio=0.5).collect()
    for source in "ab":
        mine = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 30


INNER = (
    "size place of whole cut target source_size repeats taken copy row _d _t _tid _gone gone gone_id gone_tid "
    "tid number node key same fresh n_lines n_removed Size N_Lines words docs first level template low held bin"
).split()


def test_names_used_inside_may_be_columns(spark, corpus):
    """Every column stays as it is, but for those that the operator adds."""
    df = table(spark, [(d, t, "ab"[(d or 0) % 2]) for d, t in corpus[:40]])
    for c in INNER:
        if c.lower() not in [x.lower() for x in df.columns]:
            df = df.withColumn(c, F.lit(f"own {c}"))
    added = {"size", "source_size", "target", "repeats", "copy"}
    mixed = mixing.mixed_documents(df)
    assert [c for c in mixed.columns if c not in added] == [c for c in df.columns if c.lower() not in added]
    assert {r["cut"] for r in mixed.collect()} == {"own cut"}
    added = {"n_lines", "n_removed"}
    kept = lines.drop_recurring_lines(df, 3)
    assert [c for c in kept.columns if c not in added] == [c for c in df.columns if c.lower() not in added]
    rows = kept.collect()
    assert len(rows) == 40 and {(r["gone"], r["tid"]) for r in rows} == {("own gone", "own tid")}


def test_mixing_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = con.execute(queries.ORACLES["op6_mixing"]).fetchall()
    got = queries.QUERIES["op6_mixing"](spark, folder)
    assert rows_of(got, "doc_id", "size", "source_size", "target", "taken") == sorted(want, key=str)


PAGES = [
    (3, "http://a.b/x", "<p>same</p>"),
    (1, "http://a.b/y\r\nEvil: 1", "<p>same</p>"),
    (2, None, None),
    (9, "u", ""),
    (4, "http://a.b/é", "é" * 70_000),
    (5, "u", "<p>same</p>"),
    (5, "u", "<p>same</p>"),
    (None, "u", "not lost"),
    (6, "u", "six"),
    (6, "u", "six"),
]


@pytest.mark.parametrize("least", [0, 11, 12])
def test_warc(spark, least):
    pages = spark.createDataFrame([(*p, 1, "c") for p in PAGES], "page_id long, url string, html string, data int, own string")
    rows = warc.archive_round_trip(pages, least).collect()
    assert len({r["record_id"] for r in rows}) == len(rows) == len(PAGES)
    want = []
    for page, url, html in PAGES:
        body = (html or "").encode()
        twins = [p for p, _, h in PAGES if (h or "").encode() == body]
        first = min((p for p in twins if p is not None), default=None)
        kind = "revisit" if len(body) >= least and page != first else "response"
        want.append((page, len(body), warc.digest(body), kind, first if kind == "revisit" else None))
    if least == 0:
        # Of the equal rows of page 6, one refers to the other.
        want[want.index((6, 3, warc.digest(b"six"), "response", None))] = (6, 3, warc.digest(b"six"), "revisit", 6)
    assert sorted((tuple(r[c] for c in warc_columns) for r in rows), key=str) == sorted(want, key=str)
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


warc_columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_warc_keeps_every_version(spark):
    rows = [(1, "u", "a"), (1, "u", "b"), (1, "v", "b"), (1, "v", "b"), (None, "u", "a"), (None, None, "z"), (None, None, "z")]
    got = warc.archive_round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"))
    kinds = [(r["page_id"], r["record_type"], r["refers_to"]) for r in got.collect()]
    assert sorted(kinds, key=str) == sorted(
        [(1, "response", None)] * 2
        + [(1, "revisit", 1)] * 2
        + [(None, "revisit", 1), (None, "response", None), (None, "revisit", None)],
        key=str,
    )
    ids = [r["record_id"] for r in got.collect()]
    assert len(set(ids)) == 7 and "urn:page:1" in ids


def test_warc_seeks(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i} " * i) for i in range(200)], "page_id long, url string, html string")
    path = str(tmp_path / "bundles")
    warc.write_bundles(pages, path, frame_bytes=2_000, bundle_bytes=1_000)
    bundles = spark.read.parquet(path)
    assert bundles.count() > 3
    got = warc.read_records(bundles, ["urn:page:7", "urn:page:150"]).collect()
    assert {r["page_id"]: r["payload"].decode() for r in got} == {7: "page 7 " * 7, 150: "page 150 " * 150}
    row = bundles.head()
    # Any reader of the format can decompress the whole bundle, the seek table being skippable.
    plain_ = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(bytes(row["data"])), read_across_frames=True).read()
    assert plain_.count(b"WARC/1.1\r\n") == len(row["index"])
    with pytest.raises(ValueError):
        warc.BundleReader(bytes(row["data"])[:-1])


ITEM = (
    "Early today the train to Paris leaves with 120 crates of ripe apples and travels over the long hill "
    "before the old porter called Anna counts the crates and finds that 120 of them are still there for Paris"
)


def leaks(spark, texts, items=((1, ITEM),)):
    docs = table(spark, list(enumerate(texts)))
    bench = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    return sorted((r["doc_id"], r["item_id"], r["changed"]) for r in decontaminate.find_leaks(docs, bench).collect())


def test_leaks(spark):
    other = ITEM.replace("120", "75").replace("Paris", "Rome").replace("Anna", "Eve")
    mixed = ITEM.replace("120 of", "75 of")
    texts = [ITEM, "before it\n" + ITEM.replace("apples", "Apples").replace("the", "THE") + ". after", other, mixed, None, "", "the train leaves", "x " * 5000 + ITEM]
    got = leaks(spark, texts)
    # Other values for all slots are a leak, as is a copy but for one of two equal slots.
    assert {(0, 1, 0), (2, 1, 5), (3, 1, 1), (7, 1, 0)} <= set(got) and not {4, 5, 6} & {d for d, *_ in got}
    # With no long part left word for word, the slots must agree.
    form = "this morning {} bought {} red apples and later {} sold {} green pears while {} kept {} blue plums and ate {} of them"
    item = form.format("Anna", 12, "Bob", 12, "Carl", 12, 12)
    fine, torn = form.format("Eve", 9, "Tom", 9, "Jim", 9, 9), form.format("Eve", 9, "Tom", 8, "Jim", 7, 6)
    assert leaks(spark, [fine, torn], [(1, item)]) == [(0, 1, 7)]
    assert [decontaminate.longest_run(x) for x in ((), (4,), (1, 2, 3, 7, 8), (9, 8, 7, 1))] == [0, 1, 3, 3]


def test_leaks_in_other_case(spark):
    upper = "before it\n" + ITEM.replace("apples", "Apples").replace("the", "THE") + ". after"
    got = leaks(spark, [upper, ITEM.upper(), ITEM.title(), ITEM.lower()])
    assert got == [(i, 1, 0) for i in range(4)]
    short = [(1, "What is the sum of 12 and 30 apples today"), (2, "5 6 7 8 9 10 11 12")]
    texts = ["Question: What is the sum of 12 and 30 apples today", "Question: What is the sum of 15 and 70 apples today", "row 5 6 7 8 9 10 11 12"]
    assert leaks(spark, [*texts, "Question: Paris is the sum of 15 and 70 apples today"], short) == [(0, 1, 0), (1, 1, 2), (2, 2, 0)]


def test_leaks_edges(spark, sf):
    assert leaks(spark, [ITEM], [(1, None), (2, "one two three"), (None, ITEM), (4, "5 6 7 8 9 10 11 12")]) == []
    assert leaks(spark, [ITEM, ITEM], [(7, ITEM), (7, ITEM)]) == [(0, 7, 0), (1, 7, 0)]
    assert leaks(spark, []) == [] and leaks(spark, [ITEM], []) == []
    docs, bench = (pq.read_table(f"/root/testdata/sf0.01/{t}.parquet").to_pylist() for t in ("documents", "benchmark"))
    want = {(d["doc_id"], b["item_id"]) for d in docs for b in bench if b["text"] in (d["text"] or "")}
    got = queries.QUERIES["op4_decontamination"](spark, "/root/testdata/sf0.01").collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want


def test_licenses(spark):
    rows = [
        ("f1", "h/lib/LICENSE", "MIT License\nReleased under the MIT License."),
        ("f2", "h/lib/src/a.c", "no statement here"),
        ("f3", "h/lib/src/b.c", "// Licensed under the Apache License, Version 2.0."),
        ("f4", "h/other/c.c", "licensed to nobody; the public work is under version"),
        ("f5", "h/lib/src/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
        ("f6", "h/lib/src/deep/d.c", None),
        ("f7", None, "Released under the MIT License."),
        ("f8", None, None),
        ("f9", "h/lib/", ""),
        ("f2", "h/lib/src/a.c", "no statement here"),
    ]
    files = spark.createDataFrame([(*r, 1, "x") for r in rows], "file string, path string, text string, line int, token string")
    got = [(r["file"], r["license"], r["origin"], r["inherited_from"]) for r in licenses.scan(files).collect()]
    gpl = "h/lib/src/COPYING.txt"
    assert sorted(got) == [
        ("f1", "MIT", "own", None),
        ("f2", "GPL-3.0", "inherited", gpl),
        ("f2", "GPL-3.0", "inherited", gpl),
        ("f3", "Apache-2.0", "own", None),
        ("f4", None, None, None),
        ("f5", "GPL-3.0", "own", None),
        ("f6", "GPL-3.0", "inherited", gpl),
        ("f7", "MIT", "own", None),
        ("f8", None, None, None),
        ("f9", "MIT", "inherited", "h/lib/LICENSE"),
    ]
    assert licenses.scan(files.limit(0)).count() == 0


def test_empty_tables(spark, corpus):
    empty = table(spark, corpus).limit(0)
    for run in (
        repeats.remove_repeats,
        suffixes.remove_earlier_strings,
        jaccard.near_duplicates,
        lines.drop_recurring_lines,
    ):
        assert run(empty).count() == 0


def test_near_duplicates_odd_rows(spark, corpus):
    odd = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A B c d e f g"), (None, "a b c d e f g"), (3, None), (4, "")]
    got = jaccard.near_duplicates(table(spark, odd), jaccard.Similarity(4, 85))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(
        [(1, 4, 1), (1, 4, 1), (2, 4, 1), (None, 4, 1), (3, 0, 3), (4, 0, 4)], key=str
    ) or rows_of(got, "doc_id", "component_id")[-1] == (None, None)


def test_digest_is_bare_base32():
    assert warc.digest(b"") == base64.b32encode(hashlib.sha1(b"").digest()).decode()
