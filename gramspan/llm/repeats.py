"""Removal of word windows that occur more than once, by level-wise doubling.

The windows of the first level are short; windows repeated at one length alone
are extended to twice that length (the last step to the width asked for),
until no candidates survive or the width is reached. Below the width, a level
looks at one short window per run only: the one with the least hash among the
short windows inside each window of full width. Two equal windows agree on it,
so if it does not occur twice, nothing around it can.

Each level is one shuffle of hashes, sorted and read as a stream, in which a
task holds no more than a batch, however often a window occurs. Documents with
exactly equal texts are settled by their text hash: one of them stands for all
in the last level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramspan.llm.common import stored, texts
from gramspan.llm.hashing import Block, Rolling, blocks, mix, signed, sliding, winnow

WIDTH = 35
# Words of the shortest windows that are looked at; each level doubles them.
FIRST = 9


def levels(width: int, first: int) -> list[int]:
    """Window lengths from about ``first`` to ``width``, each at most twice the one before."""
    out = [width]
    while out[0] > first and out[0] > 1:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _scoped(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes made distinct between the texts of a block."""
    return mix(hashes ^ (owner.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA24BAED4963EE407))


class Windows:
    """The windows of a block of texts and the anchors that decide on them."""

    def __init__(self, body: list[bytes], width: int):
        self.block = Block(body)
        self.block.words()
        words = self.block.word_hashes()
        self.rolling, self.check, self.width = Rolling(words), Rolling(words, 1), width
        owner = self.block.owner
        n = max(len(owner) - width + 1, 0)
        self.valid = owner[:n] == owner[width - 1 :] if n else np.zeros(0, bool)

    def least(self, length: int) -> np.ndarray:
        """For each window, the least hash of the ``length``-word windows inside it."""
        if not len(self.valid):
            return np.zeros(0, np.uint64)
        return sliding(self.rolling.windows(length), self.width - length + 1)

    def surviving(self, length: int, repeated: list[np.ndarray]) -> np.ndarray:
        """Valid windows whose anchor at ``length`` is among those of their text in ``repeated``."""
        if not len(self.valid):
            return self.valid
        owner = np.repeat(np.arange(len(repeated)), [len(r) for r in repeated])
        known = _scoped(np.concatenate([*repeated, np.zeros(0, np.uint64)]), owner)
        mine = _scoped(self.least(length), self.block.owner[: len(self.valid)])
        return self.valid & np.isin(mine, known)

    def anchors(self, length: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and positions of the anchors of the wanted windows."""
        if not len(wanted):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        hashes = self.rolling.windows(length)
        at = np.flatnonzero(winnow(hashes, self.width - length + 1, wanted))
        return hashes[at], at


def _lists(column: pa.Array) -> list[np.ndarray]:
    """A list column as arrays of unsigned hashes; null is empty."""
    return [np.array(x or (), np.int64).view(np.uint64) for x in column.to_pylist()]


def _anchor_rows(docs: DataFrame, length: int, width: int, before: int | None) -> DataFrame:
    """``h, doc_id, tag, many``: the anchors of each document, and whether it has one more than once."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, body in blocks(batch):
                w = Windows(body, width)
                wanted = w.valid if before is None else w.surviving(before, _lists(part.column(2)))
                h, at = w.anchors(length, wanted)
                owner = w.block.owner[at]
                order = np.lexsort((h, owner))
                h, owner = h[order], owner[order]
                first = np.ones(len(h), bool)
                first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
                starts = np.flatnonzero(first)
                many = np.diff(np.append(starts, len(h))) > 1
                doc, tag = (part.column(c).take(pa.array(owner[starts])) for c in (0, 3))
                columns = [signed(h[starts]), doc, tag, pa.array(many)]
                yield pa.RecordBatch.from_arrays(columns, ["h", "doc_id", "tag", "many"])

    return docs.mapInArrow(read, "h long, doc_id long, tag long, many boolean")


def repeated_rows(rows: DataFrame, keys: int, many: int | None = None) -> DataFrame:
    """The rows whose first ``keys`` columns occur in another row too.

    One shuffle on the first column; the sorted partitions are read as a
    stream, so a frequent key costs time in proportion but no memory. ``many``
    is the column that says that a row stands for several.
    """
    names = rows.columns
    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes)

    def read(batches) -> Iterator[pa.RecordBatch]:
        held, matched = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            same = np.ones(batch.num_rows - 1, bool)
            for k in range(keys):
                c = batch.column(k).to_numpy()
                same &= c[1:] == c[:-1]
            hit = np.append(same, False)
            hit[1:] |= same
            hit[0] |= matched
            if many is not None:
                hit |= batch.column(many).to_numpy(zero_copy_only=False)
            # Whether the last row has an equal one after it is not known yet.
            held, matched = batch.slice(batch.num_rows - 1), bool(hit[-1])
            yield batch.slice(0, batch.num_rows - 1).filter(pa.array(hit[:-1]))
        if held is not None and matched:
            yield held

    sorted_rows = rows.repartition(names[0]).sortWithinPartitions(*names[:keys])
    return sorted_rows.mapInArrow(read, kinds)


def equal_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, copy`` of the documents whose text another row has too.

    ``copy`` is that text's hash and the least doc_id that has it, null before all others.
    """
    key = ["_a", "_b"]
    marks = docs.select("doc_id", F.xxhash64("text").alias("_a"), F.xxhash64("text", F.lit(7)).alias("_b"))
    groups = marks.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id")).alias("least")
    ).select(*key, "n", F.col("least.doc_id").alias("leader"))
    copies = marks.join(groups.filter("n > 1"), key)
    return copies.groupBy("doc_id").agg(F.max(F.struct("_a", "leader")).alias("copy"))


def _copies(docs: DataFrame) -> DataFrame:
    """``doc_id, tag, leads`` of the texts that another row has too.

    ``leads`` is true for the least doc_id that has the text, null before all others.
    """
    marks = docs.select("doc_id", "tag", F.xxhash64("text", F.lit(7)).alias("check"))
    groups = marks.groupBy("tag", "check").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id")).alias("least"))
    copies = marks.join(groups.filter("n > 1"), ["tag", "check"])
    return copies.select("doc_id", "tag", F.col("least.doc_id").eqNullSafe(F.col("doc_id")).alias("leads")).distinct()


def _kept(body: bytes, words: list[bytes], gone: np.ndarray | None) -> str:
    if gone is not None:
        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    return hashlib.sha256(b" ".join(words)).hexdigest()


_STATE = (
    "doc_id long, tag int, n_words long, n_removed long, kept_sha256 string, text binary, "
    "w array<long>, v array<int>, p array<int>, m array<boolean>, sure array<int>"
)


def _settle(docs: DataFrame, length: int, width: int) -> DataFrame:
    """One row per document: its result, or its candidate windows and its text.

    ``docs`` has ``doc_id, text, found, copy, leads``. ``w, v`` are two hashes of the
    windows that start at ``p``. Of windows that the block has several times, one
    is shown to others, marked by ``m``; the rest are ``sure``.
    """

    def read(batches) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("doc_id", pa.int64()),
                ("tag", pa.int32()),
                ("n_words", pa.int64()),
                ("n_removed", pa.int64()),
                ("kept_sha256", pa.string()),
                ("text", pa.binary()),
                ("w", pa.list_(pa.int64())),
                ("v", pa.list_(pa.int32())),
                ("p", pa.list_(pa.int32())),
                ("m", pa.list_(pa.bool_())),
                ("sure", pa.list_(pa.int32())),
            ]
        )
        for batch in batches:
            for part, body in blocks(batch):
                x = Windows(body, width)
                found = x.surviving(length, _lists(part.column(2)))
                doc_ids, copies, leads = (part.column(i).to_pylist() for i in (0, 3, 4))
                # Of equal texts, one shows its windows to the others.
                shown = np.array([not c or bool(d) for c, d in zip(copies, leads, strict=True)])
                starts = np.flatnonzero(found)
                starts = starts[shown[x.block.owner[starts]]]
                w = x.rolling.windows(width)[starts].view(np.int64)
                v = (x.check.windows(width)[starts] >> np.uint64(33)).astype(np.int32)
                order = np.lexsort((v, w))
                new = np.ones(len(order), bool)
                new[1:] = (w[order][1:] != w[order][:-1]) | (v[order][1:] != v[order][:-1])
                first = np.flatnonzero(new)
                many, sent = np.zeros(len(order), bool), np.zeros(len(order), bool)
                sent[order[first]] = True
                many[order] = np.repeat(np.diff(np.append(first, len(order))) > 1, np.diff(np.append(first, len(order))))
                owner = x.block.owner[starts]
                bounds = np.searchsorted(owner, np.arange(len(body) + 1))
                place = (starts - x.block.word0[owner]).astype(np.int32)
                rows = []
                for i, text in enumerate(body):
                    n = int(x.block.n_words[i])
                    a, b = bounds[i], bounds[i + 1]
                    row = dict.fromkeys(schema.names)
                    row |= {"doc_id": doc_ids[i], "tag": hash_tag(text), "n_words": n, "n_removed": 0}
                    if copies[i]:
                        whole = n >= width
                        row["n_removed"] = n if whole else 0
                        row["kept_sha256"] = _kept(text, [] if whole else text.split(), None)
                    elif a == b:
                        row["kept_sha256"] = _kept(text, text.split(), None)
                    else:
                        row["text"] = text
                    if a < b:
                        to, rest = a + np.flatnonzero(sent[a:b]), a + np.flatnonzero(~sent[a:b])
                        row |= {"w": w[to], "v": v[to], "p": place[to], "m": many[to], "sure": place[rest]}
                    rows.append(row)
                yield pa.RecordBatch.from_pylist(rows, schema)

    return docs.mapInArrow(read, _STATE)


def hash_tag(text: bytes) -> int:
    """Tells rows apart that share a doc_id but not the text."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=3).digest(), "big")


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Which of ``size`` positions lie in a window of ``width`` from one of ``starts``."""
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, np.minimum(starts + width, size), -1)
    return np.cumsum(depth[:-1]) > 0


def _finish(pending: DataFrame, width: int) -> DataFrame:
    def read(batches) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("doc_id", pa.int64()),
                ("n_words", pa.int64()),
                ("n_removed", pa.int64()),
                ("kept_sha256", pa.string()),
            ]
        )
        for batch in batches:
            rows = []
            for doc_id, n, text, hits, sure in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                gone = covered(np.array([*(hits or ()), *(sure or ())], np.int64), width, n)
                rows.append((doc_id, n, int(gone.sum()), _kept(text, text.split(), gone)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
            ) if rows else pa.RecordBatch.from_pylist([], schema)

    return pending.mapInArrow(read, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, width: int = WIDTH, first: int = FIRST) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for each row of ``docs`` (``doc_id, text``).

    A word goes if a window of ``width`` consecutive words around it starts
    anywhere else too, in the same text or another; windows are judged on the
    input. Words are runs of anything but ASCII space. A null text has no
    words; texts shorter than ``width`` lose nothing. Repeated rows repeat each
    other's windows. Rows without doc_id take part like others. Extra columns
    are ignored.
    """
    # Rows that share a doc_id are told apart by their text.
    key = ["doc_id", "tag"]
    rows = texts(docs).withColumn("tag", F.xxhash64("text"))

    def with_info(info: DataFrame) -> DataFrame:
        named = info.withColumnsRenamed({"doc_id": "_d", "tag": "_t"})
        return rows.join(named, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tag") == F.col("_t")), "left")

    lengths = levels(width, first)
    if len(lengths) == 1:
        lengths = [width, width]
    known, before = rows.select("doc_id", "text", F.lit(None).cast("array<long>").alias("found"), "tag"), None
    for length in lengths[:-1]:
        anchors = _anchor_rows(known, length, width, before)
        found = repeated_rows(anchors, 1, 3).groupBy(*key).agg(F.collect_list("h").alias("found"))
        found = stored(found, "repeats-level")
        known = with_info(found).select("doc_id", "text", "found", "tag")
        before = length
        if found.isEmpty():
            break
    same = stored(_copies(rows), "repeats-copies")
    info = (
        found.withColumn("leads", F.lit(None).cast("boolean"))
        .unionByName(same.withColumn("found", F.lit(None).cast("array<long>")))
        .groupBy(*key)
        .agg(F.flatten(F.collect_list("found")).alias("found"), F.max("leads").alias("leads"))
    )
    known = with_info(info).select("doc_id", "text", "found", F.col("leads").isNotNull().alias("copy"), "leads")
    state = stored(_settle(known, before, width), "repeats-state")
    windows = state.filter("p is not null").select(
        F.explode(F.arrays_zip("w", "v", "p", "m")).alias("x"), "doc_id", "tag"
    )
    shown = windows.select("x.w", "x.v", "doc_id", "tag", "x.p", "x.m")
    hits = repeated_rows(shown, 2, 5).groupBy("doc_id", "tag").agg(F.collect_list("p").alias("hits"))
    hits = hits.select(F.col("doc_id").alias("_d"), F.col("tag").alias("_t"), "hits")
    open_rows = state.filter("text is not null").select("doc_id", "tag", "n_words", "text", "sure")
    pending = open_rows.join(
        hits, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tag") == F.col("_t")), "left"
    ).select("doc_id", "n_words", "text", "hits", "sure")
    settled = state.filter("text is null").select("doc_id", "n_words", "n_removed", "kept_sha256")
    return settled.unionByName(_finish(pending, width))
