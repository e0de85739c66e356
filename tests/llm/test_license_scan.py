"""License statements in context, against a plain cosine, and the scan over documents and pages."""

import math
import re
from collections import Counter

import pytest

from gramspan.llm import licenses, queries

WRAPPED = licenses.TEMPLATES["MIT"][4].replace(", ", ",\n * ").replace("copies", "copies\n")
CASES = {
    "GNU Affero General Public License": "This work is licensed under the GNU Affero General Public License, version 3.",
    "linked": "This work is licensed under the GNU General Public License, version 3.",
}
TEXTS = [
    ("AGPL-3.0", CASES["GNU Affero General Public License"]),
    ("GPL-3.0", "Footer (c) 2020 Acme. " + CASES["linked"] + " See terms and contact."),
    ("MIT", "Copyright (c) Acme Corp. Released under the MIT License. See LICENSE for details about it."),
    ("MIT", "MIT License\n\nCopyright (c) 2021 Someone\n\n" + WRAPPED),
    (None, "This file is not licensed under the Apache License, Version 2.0"),
    (None, "It was never released under the MIT License"),
    (None, "Released under the BSD License"),
    (None, "licensed to nobody; the public work is under version"),
    ("GPL-3.0", "# " + licenses.TEMPLATES["GPL-3.0"][3].replace(". ", ".\n# ")),
    ("GPL-2.0", "/* " + licenses.TEMPLATES["GPL-2.0"][3] + " */ int main() { return 0; }"),
    ("LGPL-2.1", licenses.TEMPLATES["LGPL-2.1"][3]),
    ("BSD-2-Clause", "Copyright 1999. All rights reserved.\n" + licenses.TEMPLATES["BSD-2-Clause"][1] + " THIS SOFTWARE"),
    ("BSD-3-Clause", "Copyright 1999. All rights reserved.\n" + licenses.TEMPLATES["BSD-3-Clause"][2] + " THIS SOFTWARE"),
    ("Proprietary", "The text. (c) All rights reserved."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Apache-2.0", "x " * 50_000 + "Licensed under the Apache License, Version 2.0." + " y" * 50_000),
    (None, ""),
    (None, None),
    (None, "plain words " * 30),
]


def plain_scores(texts):
    """Best ``(license, score)`` of each text, by windows that put some anchor at its place."""
    cut = lambda s: re.findall(licenses._TOKEN, (s or "").lower())
    words = [cut(t) for t in texts]
    df = Counter(w for ws in words for w in set(ws))
    weigh = lambda w: math.log((1 + len(texts)) / (1 + df[w])) + 1
    known = licenses.statements()
    telling = licenses.telling_tokens(known)
    out = []
    for ws in words:
        best = None
        for i, name, ts in known:
            a = {w: c * weigh(w) for w, c in Counter(ts).items()}
            length = math.sqrt(sum(v * v for v in a.values()))
            for start in {max(p - q, 0) for q, t in enumerate(ts) for p, w in enumerate(ws) if w == t}:
                window = ws[start : start + len(ts)]
                around = ws[max(start - licenses.REACH, 0) : start] + window
                if set(around) & set(licenses.NEGATIONS) and not set(ts) & set(licenses.NEGATIONS):
                    continue
                if not telling[i] <= set(window):
                    continue
                b = {w: c * weigh(w) for w, c in Counter(window).items()}
                score = sum(v * a.get(w, 0) for w, v in b.items())
                score = round(score / length / math.sqrt(sum(v * v for v in b.values())), 9)
                rank = (name == licenses.WEAKEST, -score, -len(ts), name)
                if score >= licenses.THRESHOLD and (best is None or rank < best):
                    best = rank
        out.append(best and (best[3], -best[1]))
    return out


def test_statements_in_context(spark):
    files = spark.createDataFrame([(i, t, 1.0, "x") for i, (_, t) in enumerate(TEXTS)], "file int, text string, w double, token string")
    got = {r["file"]: (r["license"], r["score"]) for r in licenses.own_licenses(files).collect()}
    want = plain_scores([t for _, t in TEXTS])
    assert [got.get(i) and got[i][0] for i in range(len(TEXTS))] == [name for name, _ in TEXTS]
    for i, w in enumerate(want):
        assert (got.get(i) is None) == (w is None)
        assert w is None or (got[i][0], got[i][1]) == (w[0], pytest.approx(w[1], abs=2e-9))


def test_inline_tags_do_not_cut_a_notice(spark):
    html = '<p>This work is licensed under the <a href="/x">GNU General Public <b>License</b></a>, version 3.</p><p>Next</p>'
    pages = spark.createDataFrame([(1, "http://h/a?q#f", html), (2, None, None)], "page_id long, url string, html string")
    files = {r["file"]: r for r in licenses.page_files(pages).collect()}
    assert files[1]["path"] == "h/a" and "GNU General Public License, version 3." in files[1]["text"]
    assert [(r["file"], r["license"]) for r in licenses.own_licenses(licenses.page_files(pages)).collect()] == [(1, "GPL-3.0")]


def test_documents_and_pages_are_one_collection(spark):
    mit = "Released under the MIT License."
    docs = [(1, mit, "a"), (1, "other text", "a"), (None, mit, None), (None, "text", "b"), (2, None, "a")]
    docs = spark.createDataFrame([(*d, "k", "f") for d in docs], "doc_id long, text string, source string, kind string, file string")
    pages = [(7, "http://h/d/", f"<p>{mit}</p>"), (8, "http://h/d/e/f", "<p>text</p>"), (8, "http://h/d/e/f", "<p>text</p>")]
    pages = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = [(r["doc_id"], r["page_id"], r["license"], r["origin"], r["inherited_from"]) for r in licenses.scan_all(docs, pages).collect()]
    assert sorted(got, key=str) == sorted(
        [
            (1, None, "MIT", "own", None),
            (1, None, None, None, None),
            (None, None, "MIT", "own", None),
            (None, None, None, None, None),
            (2, None, None, None, None),
            (None, 7, "MIT", "own", None),
            (None, 8, "MIT", "inherited", "h/d/"),
            (None, 8, "MIT", "inherited", "h/d/"),
        ],
        key=str,
    )


def test_registered_scan_finds_every_statement(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES["op9_licenses"](spark, folder).filter("license is not null")
    found = {r["doc_id"] for r in got.collect() if r["doc_id"] is not None}
    lines = r"(?m)^(Licensed under (CC|the Apache)|This work is licensed under|Released under the MIT|All rights reserved)"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert found == {r["doc_id"] for r in docs if re.search(lines, r["text"] or "")} and found
