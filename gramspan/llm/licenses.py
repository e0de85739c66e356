"""License scan: sparse TF-IDF cosine to templates, then inheritance along directories.

A file is a sequence of tokens, line breaks and inline tags aside. Document
frequencies of all tokens come from one pass over all files. A template's
anchors are its heaviest tokens, as many as any window that reaches the threshold must
have one of; where an anchor occurs, the window of the template's length that puts it at the
anchor's place is compared with the template. Headers, sentences inside
longer ones and whole licence texts are found alike, wrapped or not.

A file's own license is its best template at or above the threshold. A file
without one inherits from the nearest directory at or above it that has a
licence file: one named like ``LICENSE``, or a directory's index page, with a
license of its own. Only DataFrame functions.
"""

from __future__ import annotations

import re
from collections import defaultdict
from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramspan.llm.common import stored

# Usual statements and texts of public licenses.
_GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published "
    "by the Free Software Foundation, either version {v} of the License, or (at your option) any later version. This "
    "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution."
)
_BSD3 = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    "MIT": (
        "Released under the MIT License",
        "The MIT License (MIT)",
        "MIT License",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: GPL-3.0",
        _GPL.format(name="GNU General Public License", v="3"),
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "SPDX-License-Identifier: GPL-2.0",
        _GPL.format(name="GNU General Public License", v="2"),
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "SPDX-License-Identifier: AGPL-3.0",
        _GPL.format(name="GNU Affero General Public License", v="3"),
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: LGPL-3.0",
        _GPL.format(name="GNU Lesser General Public License", v="3"),
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        "SPDX-License-Identifier: LGPL-2.1",
        _GPL.format(name="GNU Lesser General Public License", v="2.1"),
    ),
    "BSD-2-Clause": ("SPDX-License-Identifier: BSD-2-Clause", _BSD),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license",
        "SPDX-License-Identifier: BSD-3-Clause",
        _BSD + _BSD3,
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC0-1.0": ("Released under CC0 1.0 Universal", "Dedicated to the public domain under CC0 1.0"),
    "ISC": (
        "ISC License",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain",
        "SPDX-License-Identifier: Unlicense",
    ),
    "Proprietary": ("All rights reserved",),
}
# Says something only where nothing else is said.
WEAKEST = "Proprietary"
# Words that turn a statement round, in it or shortly before it.
NEGATIONS, REACH = ("not", "never", "neither", "nor", "isn", "aren", "cannot"), 5

THRESHOLD = 0.75
# Of short statements, the tokens found in this many licenses at most must all be there: names and versions.
TELLING, SHORT = 2, 25
_TOKEN = r"[a-z0-9](?:[a-z0-9.\-]*[a-z0-9])?"


def tokens(text: Column) -> Column:
    """Lower-case tokens; full stops and hyphens at their ends are punctuation."""
    return F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))


def statements() -> list[tuple[int, str, list[str]]]:
    """``number, license, tokens`` of every template: a fixed small list."""
    found = [(name, re.findall(_TOKEN, s.lower())) for name, all_ in TEMPLATES.items() for s in all_]
    return [(i, name, words) for i, (name, words) in enumerate(found)]


def telling_tokens(known: list[tuple[int, str, list[str]]]) -> dict[int, set[str]]:
    """The tokens that a window must have, by statement."""
    licenses = defaultdict(set)
    for _, name, words in known:
        for w in words:
            licenses[w].add(name)
    return {
        i: {w for w in words if len(licenses[w]) <= TELLING or w[0].isdigit()} if len(words) <= SHORT else set()
        for i, _, words in known
    }


def anchors(vector: dict[str, float], threshold: float) -> set[str]:
    """The heaviest tokens of a template: a window without any of them is below the threshold."""
    left = total = sum(w * w for w in vector.values())
    out = set()
    for token, w in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
        if left < threshold**2 * total * (1 - 1e-9):
            break
        out.add(token)
        left -= w * w
    return out


def own_licenses(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``file, license, score`` of the files (``file, text``) with a license of their own."""
    spark = files.sparkSession
    words = tokens(F.coalesce(F.col("text"), F.lit("")))
    df = files.select(F.explode(F.array_distinct(words)).alias("token")).groupBy("token")
    df = stored(df.agg(F.count(F.lit(1)).alias("df")), "license-tokens")
    n = files.count()
    known = statements()
    vocabulary = sorted({w for _, _, ws in known for w in ws})
    # No more rows than the vocabulary of the templates.
    found = {r["token"]: r["df"] for r in df.filter(F.col("token").isin(vocabulary)).collect()}
    idf = lambda count: log((1 + n) / (1 + count)) + 1
    telling = telling_tokens(known)
    places, weights, shapes = [], [], []
    for i, name, ws in known:
        vector = {w: ws.count(w) * idf(found.get(w, 0)) for w in set(ws)}
        norm = sqrt(sum(v * v for v in vector.values()))
        weights += [(i, w, v / norm, w in telling[i]) for w, v in vector.items()]
        heavy = anchors(vector, threshold)
        places += [(w, i, at) for at, w in enumerate(ws) if w in heavy]
        shapes.append((i, name, len(ws), len(telling[i]), any(w in NEGATIONS for w in ws)))
    place = spark.createDataFrame(places, "token string, statement int, at int")
    weight = spark.createDataFrame(weights, "statement int, token string, w double, telling boolean")
    shape = spark.createDataFrame(shapes, "statement int, license string, size int, need int, negative boolean")

    heavy = F.array(*[F.lit(w) for w in sorted({p[0] for p in places})])
    near = files.select("file", F.xxhash64("text").alias("tid"), words.alias("words"))
    near = stored(near.filter(F.arrays_overlap("words", heavy)).dropDuplicates(["file", "tid"]), "license-files")
    hits = near.select("file", "tid", F.posexplode("words").alias("pos", "token")).join(F.broadcast(place), "token")
    starts = hits.select("file", "tid", "statement", F.greatest(F.col("pos") - F.col("at"), F.lit(0)).alias("start"))
    at = starts.distinct().join(F.broadcast(shape), "statement").join(near, ["file", "tid"])
    ahead = F.least(F.col("start"), F.lit(REACH))
    around = F.slice("words", F.col("start") - ahead + 1, F.col("size") + ahead)
    denied = F.arrays_overlap(around, F.array(*map(F.lit, NEGATIONS))) & ~F.col("negative")
    key = ["file", "tid", "statement", "start"]
    inside = at.filter(~denied).select(*key, F.explode(F.slice("words", F.col("start") + 1, F.col("size"))).alias("token"))
    tf = stored(inside.groupBy(*key, "token").agg(F.count(F.lit(1)).alias("tf")), "license-windows")
    # What the other tokens of the windows weigh.
    asked = df.join(tf.select("token").distinct(), "token", "left_semi")
    heaviness = F.log(F.lit(1.0 + n) / (F.col("df") + 1.0)) + 1
    vector = tf.join(asked, "token").withColumn("v", F.col("tf") * heaviness)
    scored = (
        vector.join(F.broadcast(weight), ["statement", "token"], "left")
        .groupBy(*key)
        .agg(
            (F.sum(F.col("v") * F.coalesce("w", F.lit(0.0))) / F.sqrt(F.sum(F.col("v") * F.col("v")))).alias("score"),
            F.count_if("telling").alias("told"),
        )
        .join(F.broadcast(shape), "statement")
        .withColumn("score", F.round("score", 9))
        .filter((F.col("score") >= threshold) & (F.col("told") == F.col("need")))
    )
    # Of equal scores the longer statement, then the license that comes first by name.
    order = F.struct(
        (F.col("license") == WEAKEST).alias("weak"), (-F.col("score")).alias("rank"), (-F.col("size")).alias("long"), "license"
    )
    best = scored.groupBy("file").agg(F.min(order).alias("best"))
    return best.select("file", F.col("best.license").alias("license"), (-F.col("best.rank")).alias("score"))


def directory(path: Column) -> Column:
    """The directory of a path, with its slash; of a path without one, the root, an empty text."""
    return F.regexp_extract(path, r"^(.*/)?[^/]*$", 1)


def ancestors(folder: Column) -> Column:
    """A directory and those above it, the nearest first; the root is an empty text."""
    parts = F.split(folder, "/")
    depths = F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1))
    return F.transform(depths, lambda k: F.when(k == 0, "").otherwise(F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/"))))


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``file, license, score, origin, inherited_from`` for each row of ``files`` (``file, path, text``).

    ``origin`` is ``own``, ``inherited`` or null. A null text has no license; a
    null path has no directory and neither gives nor inherits. A directory with
    several licence files has the license of the least path. Rows that repeat
    ``file`` share the best license of their texts. Extra columns are ignored.
    """
    known = files.select("file", "path", "text")
    own = stored(own_licenses(known, threshold), "license-own")
    place = known.select("file", "path").join(own, "file", "left")
    name = F.lower(F.regexp_extract("path", r"([^/]*)$", 1))
    is_source = (name == "") | name.rlike(r"^(licen[sc]e|copying|copyright|unlicense|legal|notice)([.\-_].*)?$")
    sources = (
        place.filter(F.col("license").isNotNull() & F.col("path").isNotNull() & is_source)
        .groupBy(directory(F.col("path")).alias("folder"))
        .agg(F.min(F.struct("path", "license")).alias("given"))
    )
    asking = (
        place.filter(F.col("license").isNull() & F.col("path").isNotNull())
        .select("path")
        .distinct()
        .select("path", F.posexplode(ancestors(directory(F.col("path")))).alias("up", "folder"))
    )
    nearest = asking.join(sources, "folder").groupBy("path").agg(F.min(F.struct("up", "given")).alias("near"))
    nearest = nearest.select("path", F.col("near.given").alias("given"))
    out = place.join(nearest, "path", "left")
    return out.select(
        "file",
        F.coalesce("license", "given.license").alias("license"),
        "score",
        F.when(F.col("license").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited").alias("origin"),
        F.when(F.col("license").isNull(), F.col("given.path")).alias("inherited_from"),
    )


_INLINE = "a|abbr|acronym|b|bdi|bdo|big|cite|code|em|font|i|kbd|mark|q|s|samp|small|span|strong|sub|sup|tt|u|var"


def page_files(pages: DataFrame) -> DataFrame:
    """Web pages as files: ``host/path`` without query and fragment, and the text without tags.

    Inline tags are nothing, others break the line.
    """
    bare = F.regexp_replace("url", r"^[a-zA-Z][a-zA-Z0-9+.\-]*://|[?#].*$", "")
    # A page of a bare host is its root directory's index.
    path = F.when(F.instr(bare, "/") == 0, F.concat(bare, F.lit("/"))).otherwise(bare)
    text = F.regexp_replace("html", rf"(?i)</?(?:{_INLINE})(?:\s[^<>]*)?>", "")
    text = F.regexp_replace(text, r"<[^>]*>", "\n")
    return pages.select(F.col("page_id").alias("file"), path.alias("path"), text.alias("text"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files of the directory that their source is; without source, of none."""
    path = F.concat_ws("/", "source", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))
    return docs.select(
        F.col("doc_id").alias("file"), F.when(F.col("source").isNotNull(), path).alias("path"), F.col("text").alias("text")
    )


def scan_all(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """``doc_id, page_id, license, score, origin, inherited_from`` of all documents and pages.

    They are one collection: frequencies are counted over both, and one of the two ids is null.
    Rows that share an id, or have none, are told apart by their text.
    """
    both = [document_files(docs).withColumn("kind", F.lit("d")), page_files(pages).withColumn("kind", F.lit("p"))]
    files = both[0].unionByName(both[1]).select(
        F.struct("kind", "file", F.xxhash64("text").alias("tid")).alias("file"), "path", "text"
    )
    found = scan(files)
    number = lambda kind: F.when(F.col("file.kind") == kind, F.col("file.file"))
    return found.select(
        number("d").alias("doc_id"), number("p").alias("page_id"), "license", "score", "origin", "inherited_from"
    )
