"""Whitening, ranked search and packing against plain versions and on odd rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from decimal import Decimal
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plain import table

from gramspan.llm import packing, queries, search, whitening

# --- whitening ---------------------------------------------------------------


def orthogonal(rng, d):
    q = np.linalg.qr(rng.normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (3 * np.eye(d, dtype=np.longdouble) - q.T @ q) / 2
    return q


@pytest.mark.parametrize(
    "values",
    [
        np.array([3, 2, 2 - 1e-9, 2 - 2e-9, 1, 1, 1, 1e-3, 1e-5]),
        1 + 1e-10 * np.arange(30) ** 2,
        np.repeat([1.0, 2.0], [20, 5]),
        np.logspace(0, -12, 40),
        np.array([5.0]),
        np.zeros(4),
    ],
)
def test_eigen_resolves_clusters(values):
    rng = np.random.default_rng(3)
    q = orthogonal(rng, len(values))
    a = (q * values.astype(np.longdouble)) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.eigen(a)
    norm = max(float(np.abs(values).max()), 1e-300)
    assert np.all(np.diff(found) <= 1e-17 * norm)
    assert np.abs(a @ x - x * found).max() <= 1e-15 * norm
    assert np.abs(x.T @ x - np.eye(len(values))).max() <= 1e-17
    assert np.abs(found - np.sort(values)[::-1]).max() <= 1e-17 * norm


def test_refinement_goes_beyond_single_precision():
    rng = np.random.default_rng(4)
    q = orthogonal(rng, 12)
    a = (q * np.arange(1, 13).astype(np.longdouble)) @ q.T
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    assert np.abs(start.T @ start - np.eye(12)).max() > 1e-9
    values, x = whitening.refine((a + a.T) / 2, start)
    assert np.abs(a @ x - x * values).max() < 1e-16


VECTORS = "vec_id long, embedding array<float>, label int, size int, place int, n int, high int, _v int, whitened string"


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, 5, 6, "w") for i, v in rows], VECTORS)


def plain_whitening(rows, most=32):
    fit = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows]
    n, d = len(fit), len(fit[0][1])
    sums = [sum(x[j] for _, x in fit) for j in range(d)]
    centred = [[n * x[j] - sums[j] for j in range(d)] for _, x in fit]
    v = np.array([[float(Fraction(sum(y[a] * y[b] for y in centred), n**3)) for b in range(d)] for a in range(d)])
    values, x = np.linalg.eigh(v)
    values, x = values[::-1][:most], x[:, ::-1][:, :most]
    out = (np.array(centred, float) / n) @ x / np.sqrt(values)
    return [sum(c * c for c in y) for y in centred], out, values / np.trace(v)


def test_whitening_equals_dense_solution(spark):
    rng = np.random.default_rng(7)
    mix = rng.normal(size=(6, 6))
    rows = [(i, (rng.normal(size=6) @ mix + 3).astype(np.float32).tolist()) for i in range(300)]
    rows += [(None, rows[0][1]), (5, rows[1][1]), (5, rows[1][1])]
    odd = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5)]
    odd += [(904, []), (905, [1.0, 2.0])]
    found = whitening.whitened_components(vector_table(spark, rows + odd).repartition(3)).toPandas()
    assert list(found.columns) == "vec_id component n deviation whitened explained identity_error".split()
    assert len(found) == 6 * len(rows) and set(found["component"]) == set(range(1, 7)) and set(found["n"]) == {303}
    deviations, out, explained = plain_whitening(rows)
    assert sorted(found["deviation"]) == sorted(d for d in deviations for _ in range(6))
    assert found["identity_error"].nunique() == 1 and 0 < found["identity_error"][0] < 1e-9
    for i, (vec, _) in enumerate(rows):
        if vec is None or vec == 5:
            continue
        mine = found[found["vec_id"] == vec].sort_values("component")
        assert np.allclose(np.abs(mine["whitened"]), np.abs(out[i]), atol=1e-9)
        assert np.allclose(mine["explained"], explained, rtol=1e-9)


def test_whitening_without_variance(spark):
    empty = vector_table(spark, [])
    assert whitening.whitened_components(empty).collect() == []
    assert whitening.whitened_components(vector_table(spark, [(1, [1.0, 2.0])] * 3)).collect() == []
    flat = vector_table(spark, [(i, [float(i), 1.0, float(2 * i)]) for i in range(20)])
    found = whitening.whitened_components(flat).toPandas()
    # One direction has variance but for the rounding down of 64 * c, which is exact here.
    assert set(found["component"]) == {1} and np.allclose(found["explained"], 1)


def test_deviations_beyond_a_long_are_exact():
    z = np.array([[1 << 40, -5], [3, 7]], np.int64)
    n, rest = 10**6, [17, -400_000]
    want = [Decimal(sum((n * int(v) - r) ** 2 for v, r in zip(row, rest, strict=True))) for row in z]
    assert whitening._deviations(z, rest, n).to_pylist() == want
    assert whitening._deviations(z[1:] * 0 + 3, [1, 2], 5).to_pylist() == [Decimal(14**2 + 13**2)]


def test_whitening_of_huge_entries(spark):
    rows = [(i, [3e38 if i % 2 else -3e38, float(i)]) for i in range(8)]
    found = whitening.whitened_components(vector_table(spark, rows)).toPandas()
    assert len(found) and np.isfinite(found["whitened"]).all() and found["deviation"].isna().all()


# --- ranked search -------------------------------------------------------------


def plain_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain_search(docs, items, most=10):
    terms = [(doc, Counter(plain_terms(t))) for doc, t in docs]
    terms = [(doc, c) for doc, c in terms if c]
    total, df = sum(sum(c.values()) for _, c in terms), Counter(t for _, c in terms for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in terms:
            m = 25 + (75 * sum(c.values()) * len(terms)) // total
            s = 0
            for t in plain_terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * len(terms) + 2) / (2 * df[t] + 1)))
                    s += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        for rank, (s, none, doc) in enumerate(sorted(scores)[:most], 1):
            out.append((item, rank, None if none else doc, -s))
    return sorted(out, key=str)


ITEMS = "item_id long, text string, query long, term string, weight long, df long, rank int, block long"


def item_table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "t", 2, 3, 4, 5) for i, t in rows], ITEMS)


@pytest.fixture(scope="module")
def items(corpus):
    r = random.Random(8)
    texts = [t for _, t in corpus if t and len(t.split()) > 20]
    rows = [(i, " ".join(r.sample(r.choice(texts).split(), 12))) for i in range(12)]
    rows += [(20, "und und UND"), (21, None), (22, ""), (23, "--- !!"), (24, "nowhere123"), (None, rows[0][1])]
    return rows + [(3, rows[3][1]), (3, rows[4][1]), (30, texts[0] + " ÄÉ ß two")]


@pytest.mark.parametrize("block, width, terms", [(8 << 20, 64, 200_000), (3000, 1, 40)])
def test_search(spark, corpus, items, monkeypatch, block, width, terms):
    monkeypatch.setattr(search, "BLOCK_TEXT", block)
    monkeypatch.setattr(search, "WIDTH", width)
    monkeypatch.setattr(search, "ITEM_TERMS", terms)
    docs = corpus + [(None, corpus[3][1]), (None, "two"), (7, "another two two"), (7, "another two two")]
    found = search.search(table(spark, docs).repartition(3), item_table(spark, items))
    got = sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect()), key=str)
    assert got == plain_search(docs, items)


def test_search_empty_tables(spark, corpus, items):
    docs, none = table(spark, corpus[:10]), item_table(spark, [])
    assert search.search(docs, none).collect() == []
    assert search.search(docs.limit(0), item_table(spark, items)).collect() == []
    assert search.search(table(spark, [(1, None), (2, " . ")]), item_table(spark, items)).collect() == []


def test_range_maximum_and_pruning():
    rng = np.random.default_rng(1)
    lists = [np.sort(rng.choice(5000, n, replace=False)).astype(np.int32) for n in (1, 5000, 37, 800, 2500)]
    impacts = rng.integers(0, 50, sum(map(len, lists)))
    impacts[rng.integers(0, len(impacts), 40)] += 1000
    p = search.Postings(lists, impacts, 5000)
    a = rng.integers(0, 5000, 300)
    b = a + 1 + rng.integers(0, 5000, 300) % (5000 - a)
    begin = p.begin[1]
    at = p.greatest(begin + a, begin + b)
    assert [int(impacts[i]) for i in at] == [int(impacts[begin + x : begin + y].max()) for x, y in zip(a, b)]
    weight = np.array([9, 1, 5, 3, 2])
    item = search.Item(p, np.arange(5), weight, 10)
    places, scores = item.best()
    dense = np.zeros(5000, np.int64)
    for w, s, e in zip(weight, p.begin, p.end):
        dense[p.places[s:e]] += w * impacts[s:e]
    order = np.lexsort((np.arange(5000), -dense))[:10]
    assert places.tolist() == order.tolist() and scores.tolist() == dense[order].tolist()
    # Bounds leave most documents unopened.
    assert item.scored < 2500


# --- packing -------------------------------------------------------------------

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_words_are_encoded_as_in_whole_texts():
    """Cutting and folding words here changes no id."""
    r = random.Random(2)
    letters = "abzAZ09 '.,<|>-_ÀÉßŸİǅȺ×÷ÿžΣςσ漢字١²́\u00a0\u2028\u0085\x00\x1c\x7f\n\t🙂ﬁ"
    words = ["it's", "DON'T", "<|endoftext|>", "<|startoftext|>x", "a<|b", "é", "É'S", "naïve42", "ſ", "ŉ", "'ll"]
    body = []
    for _ in range(400):
        some = ["".join(r.choice(letters) for _ in range(r.randint(1, 9))) for _ in range(r.randint(0, 12))]
        body.append(r.choice([" ", "\n", "  ", ""]).join(some + r.choices(words, k=3)))
    body += ["", " ", "\n\t", "x" * 5000, "é" * 3000]
    spec = open(TOKENIZER, encoding="utf-8").read()
    tokenizer = Tokenizer.from_str(spec)
    want = [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in body]
    assert [x.tolist() for x in packing.WordEncoder(spec).encode([t.encode() for t in body])] == want
    general = packing.WordEncoder(spec)
    general.plain = None
    assert [x.tolist() for x in general.encode([t.encode() for t in body])] == want


def check_packing(docs, rows, capacity):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END]
        for k, s in enumerate(range(0, len(ids), capacity.longest)):
            part = ids[s : s + capacity.longest]
            want[doc, k, s, len(part), np.array(part, "<u4").tobytes()] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity.tokens and len(parts) <= capacity.pieces
        assert sum(n * n for _, n in parts) <= capacity.attention
    return len(sequences), sum(n for p in sequences.values() for _, n in p)


ODD = [(None, "a b"), (None, "a b"), (3, "same id"), (3, "another"), (700, "İ ΑΣ é x y z ́q <|endoftext|> it's")]


@pytest.mark.parametrize(
    "capacity",
    [
        packing.Capacity(),
        packing.Capacity(512, 6, 90_000),
        packing.Capacity(300, 300, 90_000, rule="dot", weights=(1.0, 0.5, 0.2)),
        packing.Capacity(400, 9, 10_000),
    ],
)
def test_packing(spark, corpus, capacity):
    docs = corpus + ODD
    rows = packing.pack_documents(table(spark, docs).repartition(4), TOKENIZER, capacity).collect()
    made, tokens = check_packing(docs, rows, capacity)
    if capacity.attention >= capacity.tokens**2 and capacity.pieces >= capacity.tokens:
        assert made <= math.ceil(tokens / capacity.tokens) + 1


def test_packing_in_many_loads(spark, corpus, monkeypatch):
    capacity = packing.Capacity(512, 512, 512 * 512)
    docs = corpus * 3
    once = packing.pack_documents(table(spark, docs), TOKENIZER, capacity).collect()
    least, _ = check_packing(docs, once, capacity)
    monkeypatch.setattr(packing, "HOLD_PIECES", 64)
    monkeypatch.setattr(packing, "HOLD_TOKENS", 12_000)
    rows = packing.pack_documents(table(spark, docs), TOKENIZER, capacity).collect()
    made, _ = check_packing(docs, rows, capacity)
    assert made <= 1.1 * least


def test_packing_of_nothing(spark):
    assert packing.pack_documents(table(spark, [(1, "a")]).limit(0), TOKENIZER).collect() == []
    with pytest.raises(ValueError):
        packing.Capacity(rule="first")


def test_best_fit_takes_the_fullest_that_fits():
    lengths = np.array([60, 50, 45, 40, 5])
    placed = packing.best_fit(lengths, packing.Capacity(100, 100, 10_000, weights=(1, 0, 0)))
    assert placed.tolist() == [0, 1, 1, 0, 1]
    # A sequence may be full of pieces or of attention before it is full of tokens.
    assert len(set(packing.best_fit(np.full(6, 10), packing.Capacity(100, 2, 10_000)).tolist())) == 3
    assert len(set(packing.best_fit(np.full(6, 10), packing.Capacity(100, 100, 300)).tolist())) == 2


def test_queries_of_the_new_operators(spark, sf):
    rows = queries.QUERIES["op13_packing"](spark, sf).collect()
    ids = packing.pack_documents(spark.read.parquet(f"{sf}/documents.parquet"), TOKENIZER).collect()
    key = lambda r: (r["doc_id"], r["piece"])
    assert {key(r): r["ids_crc32"] for r in rows} == {key(r): zlib.crc32(r["ids"]) for r in ids}
    found = queries.QUERIES["op11_whitening"](spark, sf)
    assert found.agg(F.max("identity_error")).head()[0] <= 1e-4
