"""Ranked lexical search with range-maximum queries on posting lists.

The index cuts the documents into blocks of bounded text. A block has a row of its
documents, in order of doc_id, and a row per term: the places of the documents
that hold it and how often. Document frequencies and lengths come from the whole
index. A search reads the posting lists of the terms asked for, block by block:

* a sparse table per posting list answers where its greatest impact in an
  interval of documents is, from two overlapping ranges of a power of two;
* the answers of an item's terms, summed, bound every score in the interval;
* the intervals with the greatest bounds are opened first: the document of the
  greatest single impact is scored and splits its interval in two;
* intervals whose bound cannot reach the best ten found so far are dropped.

Each block gives its best documents for every item; they are ranked once more.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gramspan.llm.common import stored, texts

# Text of a block; a longer document is a block of its own. Rows of a block at most.
BLOCK_TEXT, BLOCK_ROWS = 8 << 20, 1 << 16
# Rows (item, term) whose posting lists a search reads together: they reach every task.
ITEM_TERMS = 200_000
# Intervals that are opened at a time.
WIDTH = 64
# Saturation 0.8 / (0.1 * tf ...), length share 75 of 100: fixed values of the score.
ONE, TF, LENGTH, FLAT, SLOPE = 1_000_000_000, 1000, 8, 25, 75

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_TERM = np.ones(256, bool)
_TERM[:128] = [chr(c).isalnum() for c in range(128)]

INDEX = "block long, term binary, places array<int>, counts array<int>, doc_ids array<long>, tokens long"


def terms_of(body: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All terms of some texts in order, as one array of bytes, and the text of each.

    A term is a maximal run of ASCII letters and digits and of anything not
    ASCII; only A to Z are lower-cased.
    """
    data = np.frombuffer(b"\n".join(body) + b"\n", np.uint8)
    inside = _TERM[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    start, end = edge[0::2], edge[1::2]
    lengths = np.fromiter(map(len, body), np.int64, len(body)) + 1
    owner = np.searchsorted(np.cumsum(lengths), start, "right")
    ends = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    kept = pa.py_buffer(_FOLD[data[inside]].tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends.tobytes()), kept]), owner


def counted(body: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different terms, and sorted by term and text: term, text and count; also terms per text."""
    terms, owner = terms_of(body)
    coded = terms.dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    key, count = np.unique(code * len(body) + owner, return_counts=True)
    code, place = np.divmod(key, max(len(body), 1))
    return coded.dictionary, code, place, count, np.bincount(owner, minlength=len(body))


# --- index -----------------------------------------------------------------------


def _block(number: int, doc_ids: list, body: list[bytes]) -> pa.RecordBatch:
    order = sorted(range(len(body)), key=lambda i: (doc_ids[i] is None, doc_ids[i] or 0, body[i]))
    order = [i for i in order if body[i]]
    terms, code, place, count, size = counted([body[i] for i in order])
    first = np.flatnonzero(np.diff(code, prepend=-1)).astype(np.int32)
    ends = np.append(first, len(code)).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (place, count)]
    n = len(terms)
    documents = pa.RecordBatch.from_arrays(
        [
            pa.array([number]),
            pa.array([b""]),
            pa.nulls(1, pa.list_(pa.int32())),
            pa.array([size.astype(np.int32)], pa.list_(pa.int32())),
            pa.array([[doc_ids[i] for i in order]], pa.list_(pa.int64())),
            pa.array([int(size.sum())]),
        ],
        INDEX_COLUMNS,
    )
    postings = pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, number, np.int64)),
            terms.cast(pa.binary()),
            *lists,
            pa.nulls(n, pa.list_(pa.int64())),
            pa.nulls(n, pa.int64()),
        ],
        INDEX_COLUMNS,
    )
    yield documents
    yield postings


INDEX_COLUMNS = [f.split(" ")[0] for f in INDEX.split(", ")]


def build_index(docs: DataFrame) -> DataFrame:
    """The index of ``doc_id, text`` as a written table of blocks; see ``INDEX``.

    The row of a block's documents has an empty term; ``counts`` are then the
    terms per document.
    """

    def read(batches) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = context.partitionId() << 32
        ids, body, held = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if body and (held + len(text) > BLOCK_TEXT or len(body) >= BLOCK_ROWS):
                    yield from _block(number, ids, body)
                    ids, body, held, number = [], [], 0, number + 1
                ids.append(doc)
                body.append(text)
                held += len(text)
        if body:
            yield from _block(number, ids, body)

    return stored(texts(docs).mapInArrow(read, INDEX), "search-index")


# --- search inside a block ---------------------------------------------------------


class Postings:
    """Posting lists of a block with a range-maximum table for each.

    ``begin`` and ``end`` of list ``t`` are positions in ``places`` (ascending
    in a list) and ``impacts``.
    """

    def __init__(self, lists: list[np.ndarray], impacts: np.ndarray, documents: int):
        sizes = np.array([len(p) for p in lists], np.int64)
        self.end = np.cumsum(sizes)
        self.begin = self.end - sizes
        self.places = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)
        self.impacts = impacts
        self.documents = documents
        # table[offset[k] + i] is where the greatest impact of [i, i + 2**k) is; the first, if equal.
        level = np.arange(len(impacts), dtype=np.int32)
        levels, width = [level], 1
        while 2 * width <= sizes.max(initial=0):
            a, b = level[:-width], level[width:]
            level = np.where(impacts[a] >= impacts[b], a, b).astype(np.int32)
            levels.append(level)
            width *= 2
        self.offset = np.cumsum([0] + [len(v) for v in levels])[:-1]
        self.table = np.concatenate(levels)
        spans = np.arange(sizes.max(initial=0) + 1)
        spans[0] = 1
        self.power = np.floor(np.log2(spans) + 1e-12).astype(np.int64)

    def greatest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Position of the greatest impact in each range ``[a, b)``, none empty."""
        k = self.power[b - a]
        left = self.table[self.offset[k] + a]
        right = self.table[self.offset[k] + b - (1 << k)]
        return np.where(self.impacts[left] >= self.impacts[right], left, right)


class Item:
    """The best documents of a block for one item: lists ``chosen`` with multipliers ``weight``."""

    def __init__(self, postings: Postings, chosen: np.ndarray, weight: np.ndarray, most: int):
        self.p, self.weight, self.most = postings, weight[:, None], most
        # rank[t, i]: position in list t of the first document from i on.
        before = np.zeros((len(chosen), postings.documents + 1), np.int32)
        for row, t in zip(before, chosen, strict=True):
            row[postings.places[postings.begin[t] : postings.end[t]] + 1] = 1
        self.rank = np.cumsum(before, axis=1, dtype=np.int32) + postings.begin[chosen].astype(np.int32)[:, None]
        self.scored = 0

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each interval, the sum of its terms' greatest impacts and where the greatest of them is."""
        a, b = self.rank[:, low].astype(np.int64), self.rank[:, high].astype(np.int64)
        some = b > a
        a, b = np.where(some, a, 0), np.where(some, b, 1)
        best = self.p.greatest(a, b)
        value = np.where(some, self.weight * self.p.impacts[best], 0)
        top = value.argmax(0)
        return value.sum(0), self.p.places[best[top, np.arange(len(low))]]

    def scores(self, places: np.ndarray) -> np.ndarray:
        a = self.rank[:, places]
        holds = self.rank[:, places + 1] > a
        self.scored += len(places)
        return np.where(holds, self.weight * self.p.impacts[np.where(holds, a, 0)], 0).sum(0)

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the best documents: greater scores, then smaller places."""
        places, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        low, high = np.array([0]), np.array([self.p.documents])
        bound, split = self.bounds(low, high)
        while True:
            full = len(found) == self.most
            least, last = (found[-1], places[-1]) if full else (0, -1)
            open_ = (bound > least) | ((bound == least) & (low < last))
            low, high, bound, split = low[open_], high[open_], bound[open_], split[open_]
            if not len(low):
                return places, found
            if len(low) > WIDTH:
                order = np.argpartition(-bound, WIDTH)
                now, later = order[:WIDTH], order[WIDTH:]
            else:
                now, later = np.arange(len(low)), np.zeros(0, np.int64)
            at = split[now]
            places = np.concatenate([places, at])
            found = np.concatenate([found, self.scores(at)])
            order = np.lexsort((places, -found))[: self.most]
            order = order[found[order] > 0]
            places, found = places[order], found[order]
            more_low = np.concatenate([low[now], at + 1])
            more_high = np.concatenate([at, high[now]])
            some = more_high > more_low
            more_low, more_high = more_low[some], more_high[some]
            more_bound, more_split = self.bounds(more_low, more_high)
            low = np.concatenate([low[later], more_low])
            high = np.concatenate([high[later], more_high])
            bound = np.concatenate([bound[later], more_bound])
            split = np.concatenate([split[later], more_split])


def base_impacts(tf: np.ndarray, length: np.ndarray, documents: int, tokens: int) -> np.ndarray:
    """Score of a term of weight one, by its count and the length of the document."""
    different, at = np.unique(length, return_inverse=True)
    m = np.array([FLAT + (SLOPE * int(n) * documents) // tokens for n in different], np.int64)[at]
    tf = tf.astype(np.int64)
    return (ONE * tf) // (TF * tf + LENGTH * m)


def _search(index: DataFrame, items: dict[bytes, list[tuple[int, int]]], documents: int, tokens: int, most: int) -> DataFrame:
    """``query, doc_id, score``: each block's best documents.

    ``items`` has for a term the queries it is in, with its weight there.
    """

    def answer(ids, sizes, lists):
        lists = [row for row in lists if row[0] in items]
        if not lists:
            return
        sizes = np.asarray(sizes, np.int64)
        places = [row[1] for row in lists]
        all_places = np.concatenate(places)
        impacts = base_impacts(np.concatenate([row[2] for row in lists]), sizes[all_places], documents, tokens)
        postings = Postings(places, impacts, len(sizes))
        asked = defaultdict(list)
        for t, row in enumerate(lists):
            for number, weight in items[row[0]]:
                asked[number].append((t, weight))
        numbers, docs, scores = [], [], []
        for number, chosen in asked.items():
            t, weight = np.array(chosen, np.int64).T
            at, found = Item(postings, t, weight, most).best()
            numbers += [number] * len(at)
            docs += [ids[i] for i in at]
            scores += found.tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())],
            ["query", "doc_id", "score"],
        )

    def read(batches) -> Iterator[pa.RecordBatch]:
        now, ids, sizes, lists = None, None, None, []
        for batch in batches:
            blocks, terms = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for r, (block, term) in enumerate(zip(blocks, terms, strict=True)):
                if block != now:
                    if lists:
                        yield from answer(ids, sizes, lists)
                    now, lists = block, []
                counts = batch.column(3)[r].values
                if term == b"":
                    ids, sizes = batch.column(4)[r].values.to_pylist(), counts.to_pylist()
                else:
                    lists.append((term, batch.column(2)[r].values.to_numpy(), counts.to_numpy()))
        if lists:
            yield from answer(ids, sizes, lists)

    # The row of the documents, whose term is empty, comes first.
    rows = index.select("block", "term", "places", "counts", "doc_ids").repartition("block")
    return rows.sortWithinPartitions("block", "term").mapInArrow(read, "query long, doc_id long, score long")


# --- search ------------------------------------------------------------------------


def _item_terms(items: DataFrame) -> DataFrame:
    """``query, item_id, term, repeats``; every row of ``items`` is a query of its own."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            body = batch.column(1).to_pylist()
            terms, code, place, count, _ = counted(body)
            at = pa.array(place)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number + place),
                    batch.column(0).take(at),
                    terms.take(pa.array(code)).cast(pa.binary()),
                    pa.array(count.astype(np.int64)),
                ],
                ["query", "item_id", "term", "repeats"],
            )
            number += len(body)

    schema = "query long, item_id long, term binary, repeats long"
    return stored(texts(items, "item_id").mapInArrow(read, schema), "search-items")


def search(docs: DataFrame, items: DataFrame, most: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``most`` best documents of each item, from rank 1.

    Reads ``doc_id, text`` and ``item_id, text``. Only scores above 0 count;
    equal scores rank by ascending doc_id, none last. A null or blank text has no terms:
    such a document is not counted, such an item has no result. Rows that share
    an id, or have none, are documents or items of their own. Either table may
    be empty; the result then is. Extra columns are ignored.
    """
    return search_index(build_index(docs), items, most)


def search_index(index: DataFrame, items: DataFrame, most: int = 10) -> DataFrame:
    """``search`` in an index that has been built."""
    spark = index.sparkSession
    asked = _item_terms(items)
    held = index.filter("doc_ids is not null").agg(
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda n, c: n + F.when(c > 0, 1).otherwise(0))).alias("d"),
        F.sum("tokens").alias("t"),
    )
    documents, tokens = held.head()
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    rows = asked.count()
    if not rows or not tokens:
        return empty
    postings = index.filter("doc_ids is null")
    df = (
        postings.join(asked.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.sum(F.size("places")).alias("df"))
    )
    share = F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double")
    weighted = asked.join(df, "term").select(
        "query", "item_id", "term", (F.floor(F.log(share) * 1000) * F.col("repeats")).cast("long").alias("weight")
    )
    weighted = stored(weighted.filter("weight > 0"), "search-weights")
    parts = -(-rows // ITEM_TERMS)
    found = empty.select(F.lit(0).cast("long").alias("query"), "doc_id", "score")
    for part in range(parts):
        some = weighted.filter(F.pmod(F.xxhash64("query"), F.lit(parts)) == part)
        lists = defaultdict(list)
        for query, term, weight in some.select("query", "term", "weight").toLocalIterator():
            lists[bytes(term)].append((query, weight))
        near = postings.join(some.select("term").distinct(), "term", "left_semi")
        near = near.select(*index.columns).unionByName(index.filter("doc_ids is not null"))
        found = found.unionByName(_search(near, dict(lists), documents, tokens, most))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    names = weighted.select("query", "item_id").distinct()
    return ranked.join(names, "query").select("item_id", "rank", "doc_id", "score")
