"""Plain versions of the operators, to compare with on small tables."""

import hashlib
import re
from collections import Counter, defaultdict

# Names that operators use inside clash with these.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, found string, copy int, leader string, "
    "size string, place int, n int, cluster string, tag string, target string, text2 string"
)


def table(spark, rows):
    """A table of documents from ``(doc_id, text[, source])`` with extra columns."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, "x", 1, "y", "z", 1, 2, "c", "t", "g", "u") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text) -> list[bytes]:
    return (text or "").encode().split()


def repeats(rows, width):
    """Per row: words, words removed, hash of the rest."""
    seen = Counter(tuple(w[i : i + width]) for _, t in rows for w in [words(t)] for i in range(len(w) - width + 1))
    out = []
    for doc, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((doc, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def earlier_strings(rows, width):
    low = lambda d: -1 if d is None else d
    first = {}
    for doc, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - width + 1):
            k = b[i : i + width]
            first[k] = min(first.get(k, 1 << 62), low(doc))
    out = []
    for doc, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] < low(doc):
                gone[i : i + width] = [True] * width
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def shingles(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)])


def components(rows, k, percent):
    """``{doc: (set size, least doc reachable)}``; rows have different ids."""
    sets = {d: shingles(t, k) for d, t in rows}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for d in sorted(sets):
        common = Counter(o for g in sets[d] for o in holders[g])
        for g in sets[d]:
            holders[g].append(d)
        for o, n in common.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[o]) - n):
                a, b = sorted((root(d), root(o)))
                up[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def dropped_lines(rows, min_docs, depth=3, similarity=0.6, literal=0.5, long_docs=3, long_words=50):
    """Set of ``(doc, line number)`` that go; rows have different ids."""
    passages = defaultdict(list)
    for doc, t in rows:
        for i, line in enumerate((t or "").encode().split(b"\n")):
            if len(line.split()) >= long_words:
                passages[tuple(line.split())].append((doc, i))
    wild = b"<*>"
    mask = lambda w: wild if re.search(rb"[0-9@]|://", w) else w
    leaves = defaultdict(list)
    for doc, t in rows:
        for i, line in enumerate((t or "").encode().split(b"\n")):
            w = tuple(map(mask, line.split()))
            if w:
                leaves[len(w), w[:depth]].append((doc, i, w))
    gone = set()
    for places in passages.values():
        if len({d for d, _ in places}) >= long_docs:
            gone |= set(sorted(places)[1:])
    for (n, _), lines in leaves.items():
        docs_of = defaultdict(set)
        for doc, _, w in lines:
            docs_of[w].add(doc)
        count = Counter()
        for w, docs in docs_of.items():
            for p, token in enumerate(w):
                count[p, token] += len(docs)
        templates = defaultdict(list)
        for doc, i, w in lines:
            fixed = [(p, token) for p, token in enumerate(w) if count[p, token] >= min_docs]
            inner = sum(p >= depth for p, _ in fixed)
            words_ = sum(token != wild for _, token in fixed)
            if inner >= similarity * max(n - depth, 0) and words_ >= literal * n:
                templates[tuple(fixed)].append((doc, i))
        for places in templates.values():
            if len({d for d, _ in places}) >= min_docs:
                gone |= set(sorted(places)[1:])
    return gone
