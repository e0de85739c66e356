"""Removal of byte strings that an earlier document has too, by blockwise suffix sorting.

Only suffixes whose first ``WIDTH`` bytes may have a twin in another document
are sorted. They are found by anchors: the ``ANCHOR``-byte string with the
least hash inside each window of ``WIDTH`` bytes, which equal windows share. A
shuffle by anchor makes the suffix buckets; a bucket is the text around a few
anchors, and a task sorts one bucket at a time.

Inside a bucket the sort uses a difference cover: texts are laid out so that
anchors fall on multiples of ``PERIOD``; the positions that are in ``COVER``
modulo ``PERIOD`` are ranked first, and any two suffixes whose anchors agree
reach a ranked position after the same few bytes. Their order is then settled
by those bytes and one rank, however long they agree. Memory is bounded by the
bucket, not by the corpus.

An anchor with more than ``HOT`` occurrences is split: each of its windows is a
row of its own, keyed by the window. Windows that occur several times in one
block of texts are sent once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramspan.llm.common import stored, texts
from gramspan.llm.hashing import Block, Rolling, blocks, mix, signed, sliding
from gramspan.llm.repeats import covered, equal_texts

WIDTH, ANCHOR = 50, 16
# The differences of the cover's members give every residue modulo the period.
PERIOD, COVER = 13, (0, 1, 3, 9)
# Bytes from each residue to the next covered one, at most 5.
_SKIP = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])
_MOST = int(_SKIP.max())
_RANKED = WIDTH - _MOST
# Occurrences of an anchor from which its windows travel one by one.
HOT = 5_000
# Bytes of text that are sorted at a time.
BUCKET_BYTES = 1 << 20
_PLACE = np.uint64((1 << 31) - 1)


class Strings:
    """The windows of ``WIDTH`` bytes of a block of texts, with their anchors."""

    def __init__(self, body: list[bytes]):
        self.block = Block(body)
        values = self.block.byte_values()
        self.rolling = Rolling(values)
        self.hashes = self.rolling.windows(ANCHOR)
        n = max(len(values) - WIDTH + 1, 0)
        self.owner = np.repeat(np.arange(len(body)), self.block.lengths + 1)
        left = (self.block.first + self.block.lengths)[self.owner[:n]] - np.arange(n)
        self.valid = left >= WIDTH
        if n:
            # The least hash, and of equal ones the first: equal windows choose alike.
            place = np.arange(len(self.hashes), dtype=np.uint64)
            ranked = (self.hashes & ~_PLACE) | place
            self.anchor = (sliding(ranked, WIDTH - ANCHOR + 1)[:n] & _PLACE).astype(np.int64)
        else:
            self.anchor = np.zeros(0, np.int64)

    def among(self, lists: list[np.ndarray]) -> np.ndarray:
        """Which windows have an anchor that is in the list of their text."""
        owner = np.repeat(np.arange(len(lists), dtype=np.uint64), [len(x) for x in lists])
        scope = lambda h, o: mix(h ^ (o + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03))
        known = scope(np.concatenate([*lists, np.zeros(0, np.uint64)]), owner)
        if not len(self.anchor) or not len(known):
            return np.zeros(len(self.valid), bool)
        # One question per run of windows with the same anchor.
        new = np.flatnonzero(np.diff(self.anchor, prepend=-1))
        mine = scope(self.hashes[self.anchor[new]], self.owner[self.anchor[new]].astype(np.uint64))
        hit = np.repeat(np.isin(mine, known), np.diff(np.append(new, len(self.anchor))))
        return hit & self.valid


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """``h, doc_id``: the different anchors of each document."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, body in blocks(batch):
                s = Strings(body)
                at = np.unique(s.anchor[s.valid])
                h, owner = s.hashes[at], s.owner[at]
                order = np.lexsort((h, owner))
                h, owner = h[order], owner[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
                doc = part.column(0).take(pa.array(owner[new]))
                yield pa.RecordBatch.from_arrays([signed(h[new]), doc], ["h", "doc_id"])

    return docs.mapInArrow(read, "h long, doc_id long")


def _shared_anchors(rows: DataFrame) -> DataFrame:
    """``h, doc_id, hot`` of the anchors that occur in more than one row.

    The sorted rows are read as a stream; of the last anchor no more than
    ``HOT`` rows are held back until its end or its size is known.
    """

    def read(batches) -> Iterator[pa.RecordBatch]:
        held, running = None, False
        for batch in (*batches, None):
            last = batch is None
            if last:
                if held is None:
                    return
                table = held
            else:
                if not batch.num_rows:
                    continue
                table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            h = table.column(0).to_numpy()
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            size = np.diff(np.append(first, len(h)))
            # ``running``: the first anchor here is known to be hot and has rows before these.
            hot, many = size > HOT, size > 1
            if running:
                hot[0] = many[0] = True
            keep = len(h) if last or hot[-1] else first[-1]
            running = bool(hot[-1]) if keep == len(h) else running and len(first) == 1
            each_hot, each_many = np.repeat(hot, size)[:keep], np.repeat(many, size)[:keep]
            out = table.slice(0, keep).append_column("hot", pa.array(each_hot)).filter(pa.array(each_many))
            held = None if keep == len(h) else table.slice(keep)
            yield from out.combine_chunks().to_batches()

    return rows.repartition("h").sortWithinPartitions("h").mapInArrow(read, "h long, doc_id long, hot boolean")


def _digest(n: int, removed: int, spans: int, kept: bytes) -> dict:
    return {"n_bytes": n, "n_removed": removed, "n_spans": spans, "kept_sha256": hashlib.sha256(kept).hexdigest()}


_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _hash_lists(column: pa.Array) -> list[np.ndarray]:
    return [np.array(x or (), np.int64).view(np.uint64) for x in column.to_pylist()]


# ``place`` packs tag (24 bits), start (31) and lead (6); of what is decided, the context is the count.
_CONTEXT = "k long, doc_id long, place long, context binary"
_DECIDED = 63


def _pack(tag: np.ndarray, start: np.ndarray, lead: np.ndarray) -> np.ndarray:
    return (tag.astype(np.int64) << 37) | (start.astype(np.int64) << 6) | lead


def _unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 37, (place >> 6) & 0x7FFFFFFF, place & 63


def _contexts(state: DataFrame) -> DataFrame:
    """Runs of windows with one anchor, as the bytes they span, for the buckets.

    A window that a smaller document of the same block has too is decided here
    and passes with no bytes. A window that its document has several times is
    sent once; a run of length 0 says that there are such windows.
    """

    def read(batches) -> Iterator[pa.RecordBatch]:
        names = ["k", "doc_id", "place", "context"]
        for batch in batches:
            for part, body in blocks(batch):
                s = Strings(body)
                at = np.flatnonzero(s.among(_hash_lists(part.column(3))))
                if not len(at):
                    continue
                hot = s.among(_hash_lists(part.column(4)))[at]
                doc = part.column(0).fill_null(np.iinfo(np.int64).min).to_numpy()
                whole = s.rolling.windows(WIDTH)[at]
                owner = s.owner[at]
                order = np.lexsort((at, doc[owner], whole))
                w, d = whole[order], doc[owner][order]
                first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
                least = np.repeat(d[first], np.diff(np.append(first, len(w))))
                here = np.zeros(len(at), bool)
                here[order] = d > least
                sent = np.zeros(len(at), bool)
                sent[order[first]] = True
                again = np.unique(owner[~sent & ~here])

                def runs(mask, key, apart):
                    i = np.flatnonzero(mask)
                    p, k = at[i], key[i]
                    new = np.ones(len(p), bool)
                    new[1:] = (p[1:] != p[:-1] + 1) | (k[1:] != k[:-1]) | apart[i][1:] | apart[i][:-1]
                    b = np.flatnonzero(new)
                    return i[b], p[b], np.diff(np.append(b, len(p)))

                anchors = s.anchor[at]
                i, p, n = runs(sent, anchors, hot)
                j, q, m = runs(here, owner, np.zeros(len(at), bool))
                key = np.where(hot[i], whole[i], s.hashes[anchors[i]])
                lead = np.where(hot[i], 0, anchors[i] - p)
                joined = s.block.joined
                bytes_ = [joined[a : a + b] for a, b in zip(p.tolist(), (n + WIDTH - 1).tolist(), strict=True)]
                texts_ = np.concatenate([owner[i], owner[j], again])
                starts = np.concatenate([p, q, s.block.first[again]]) - s.block.first[texts_]
                decided = np.concatenate([m, np.zeros_like(again)])
                # What is decided goes anywhere.
                keys = np.concatenate([key, mix(starts[len(p) :].astype(np.uint64) + whole[: len(decided)].sum())])
                leads = np.append(lead, np.full(len(decided), _DECIDED))
                tags = part.column(1).to_numpy()[texts_]
                counts = [int(x).to_bytes(4, "big") for x in decided]
                yield pa.RecordBatch.from_arrays(
                    [
                        signed(keys),
                        part.column(0).take(pa.array(texts_)),
                        pa.array(_pack(tags, starts, leads)),
                        pa.array(bytes_ + counts, pa.binary()),
                    ],
                    names,
                )

    return state.select("doc_id", "tag", "text", "found", "hot").mapInArrow(read, _CONTEXT)


def bucket_repeats(
    doc: np.ndarray, lead: np.ndarray, n: np.ndarray, contexts: list[bytes]
) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes of a bucket; ``(row, offset)`` of those with a twin in a smaller document.

    Row ``i`` has ``n[i]`` suffixes, at the first bytes of ``contexts[i]``.
    """
    size = n + WIDTH - 1
    # Anchors on multiples of the period, so that equal suffixes have equal residues.
    shift = -lead % PERIOD
    slot = -(-(size + shift + 16) // PERIOD) * PERIOD
    place = np.cumsum(slot) - slot + shift
    text = np.zeros(int(slot.sum()) + 64, np.uint8)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    text[np.repeat(place - (np.cumsum(size) - size), size) + np.arange(len(data))] = data
    eight = np.lib.stride_tricks.sliding_window_view(text, 8)
    word = np.ascontiguousarray(eight).view(">u8").ravel().astype(np.uint64)

    row = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = place[row] + offset
    residue = at % PERIOD
    skip = _SKIP[residue]
    # Ranks of the covered positions that suffixes reach first.
    cover, which = np.unique(at + skip, return_inverse=True)
    steps = [*range(0, _RANKED - 8, 8), _RANKED - 8]
    keys = [word[cover + s] for s in steps]
    order = np.lexsort(keys[::-1])
    differ = np.zeros(len(cover), bool)
    for k in keys:
        differ[1:] |= k[order][1:] != k[order][:-1]
    rank = np.empty(len(cover), np.int64)
    rank[order] = np.cumsum(differ)
    # The bytes before the ranked position and those after its reach: five in all.
    rest = (_MOST - skip).astype(np.uint64)
    bits = np.uint64(8)
    front = np.where(skip > 0, word[at] >> (np.uint64(64) - bits * np.maximum(skip, 1).astype(np.uint64)), 0)
    back = np.where(rest > 0, word[at + skip + _RANKED] >> (np.uint64(64) - bits * np.maximum(rest, np.uint64(1))), 0)
    edge = (residue.astype(np.uint64) << np.uint64(40)) | (front.astype(np.uint64) << bits * rest) | back.astype(np.uint64)
    tie = rank[which]
    d = doc[row]
    order = np.lexsort((d, edge, tie))
    new = np.ones(len(order), bool)
    e, t = edge[order], tie[order]
    new[1:] = (e[1:] != e[:-1]) | (t[1:] != t[:-1])
    first = np.flatnonzero(new)
    least = np.repeat(d[order][first], np.diff(np.append(first, len(order))))
    hit = np.zeros(len(order), bool)
    hit[order] = d[order] > least
    hit = np.flatnonzero(hit)
    return row[hit], offset[hit]


_HIT = "doc_id long, tag int, start int, n int"


def _sort_buckets(contexts: DataFrame) -> DataFrame:
    """``doc_id, tag, start, n``: runs of windows that a smaller document has."""

    names = ["doc_id", "tag", "start", "n"]

    def rows(doc: pa.Array, tag: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([doc, *(pa.array(x.astype(np.int32)) for x in (tag, start, n))], names)

    def solve(table: pa.Table) -> pa.RecordBatch:
        docs = table.column(1).combine_chunks()
        tag, start, lead = _unpack(table.column(2).to_numpy())
        contexts = table.column(3).to_pylist()
        n = np.fromiter(map(len, contexts), np.int64, len(contexts)) - WIDTH + 1
        row, offset = bucket_repeats(docs.fill_null(np.iinfo(np.int64).min).to_numpy(), lead, n, contexts)
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)
        b = np.flatnonzero(new)
        return rows(docs.take(pa.array(row[b])), tag[row[b]], start[row[b]] + offset[b], np.diff(np.append(b, len(row))))

    def read(batches) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            decided = (batch.column(2).to_numpy() & 63) == _DECIDED
            if decided.any():
                done = batch.filter(pa.array(decided))
                tag, start, _ = _unpack(done.column(2).to_numpy())
                counts = np.frombuffer(b"".join(done.column(3).to_pylist()), ">u4")
                yield rows(done.column(1), tag, start, counts)
            batch = batch.filter(pa.array(~decided))
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            k = table.column(0).to_numpy()
            ends = np.append(np.flatnonzero(k[1:] != k[:-1]) + 1, len(k))
            size = np.cumsum(pc.binary_length(table.column(3)).to_numpy().astype(np.int64))
            begin = 0
            # Whole keys, up to the size of a bucket; the last key may go on in the next batch.
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                if size[b - 1] - (size[begin - 1] if begin else 0) > BUCKET_BYTES and a > begin:
                    yield solve(table.slice(begin, a - begin))
                    begin = int(a)
            last = int(ends[-2]) if len(ends) > 1 else 0
            if last > begin:
                yield solve(table.slice(begin, last - begin))
            held = table.slice(max(last, begin))
        if held is not None and held.num_rows:
            yield solve(held)

    return contexts.repartition("k").sortWithinPartitions("k").mapInArrow(read, _HIT)


def _finish(joined: DataFrame) -> DataFrame:
    """Results of ``doc_id, tag, text, copy, hits``."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("doc_id", pa.int64()),
                ("n_bytes", pa.int64()),
                ("n_removed", pa.int64()),
                ("n_spans", pa.int64()),
                ("kept_sha256", pa.string()),
            ]
        )
        for batch in batches:
            rows = []
            for doc_id, tag, text, copy, hits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = len(text)
                mine = [h for h in hits or () if h["tag"] == tag]
                some = [np.arange(h["start"], h["start"] + h["n"]) for h in mine]
                starts = np.concatenate([*some, np.zeros(0, np.int64)])
                if copy and n >= WIDTH:
                    result = _digest(n, n, 1, b"")
                elif copy or not len(starts):
                    result = _digest(n, 0, 0, text)
                else:
                    if not all(h["n"] for h in mine):
                        # A window's fate depends on its bytes: it holds wherever they are.
                        windows = Rolling(Block([text]).byte_values()).windows(WIDTH)[: n - WIDTH + 1]
                        starts = np.flatnonzero(np.isin(windows, windows[starts]))
                    gone = covered(starts, WIDTH, n)
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                    result = _digest(n, int(gone.sum()), spans, kept)
                rows.append({"doc_id": doc_id} | result)
            yield pa.RecordBatch.from_pylist(rows, schema)

    return joined.mapInArrow(read, f"doc_id long, {_RESULT}")


def remove_earlier_strings(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row of ``docs`` (``doc_id, text``).

    A byte goes if a string of ``WIDTH`` bytes around it also starts in a
    document with a smaller doc_id; strings are judged on the input and lie in
    one document. A null text is empty; a text below ``WIDTH`` bytes loses
    nothing. Rows with equal doc_id are not smaller than each other and all
    stay; a null doc_id is smaller than every other. Extra columns are ignored.
    """
    known = texts(docs)
    shared = _shared_anchors(_anchor_rows(known))
    found = stored(
        shared.groupBy("doc_id").agg(
            F.collect_list("h").alias("found"), F.collect_list(F.when(F.col("hot"), F.col("h"))).alias("hot")
        ),
        "strings-shared",
    )
    later = stored(equal_texts(known).filter(~F.col("copy.leader").eqNullSafe(F.col("doc_id"))), "strings-copies")
    info = (
        found.withColumn("copy", F.lit(None).cast(later.schema["copy"].dataType))
        .unionByName(later.withColumns({c: F.lit(None).cast("array<long>") for c in ("found", "hot")}))
        .groupBy(F.col("doc_id").alias("_d"))
        .agg(
            F.flatten(F.collect_list("found")).alias("found"),
            F.flatten(F.collect_list("hot")).alias("hot"),
            F.max("copy").alias("copy"),
        )
    )
    is_copy = F.coalesce(F.col("copy._a") == F.xxhash64("text"), F.lit(False))
    tag = F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 24)).cast("int")
    joined = known.join(info, F.col("doc_id").eqNullSafe(F.col("_d")), "left").select(
        "doc_id", tag.alias("tag"), "text", "found", "hot", is_copy.alias("copy")
    )
    hits = _sort_buckets(_contexts(joined.filter("size(found) > 0 and not copy")))
    # The texts are shuffled once: contexts and results are made where they lie.
    hits = hits.groupBy(F.col("doc_id").alias("_h")).agg(F.collect_list(F.struct("tag", "start", "n")).alias("hits"))
    waiting = joined.join(hits, F.col("doc_id").eqNullSafe(F.col("_h")), "left")
    return _finish(waiting.select("doc_id", "tag", "text", "copy", "hits"))
