"""Benchmark leaks by template windows with slot consistency.

Texts become sequences of canonical tokens: words in lower case without outer
punctuation, and typed placeholders for numbers, units (after a number) and
names (capitalised inside a sentence). Windows of such tokens are hashed and
joined to those of the benchmark. A leak is a run of matching windows on one
alignment whose slots agree: the same value in the item is always the same
value in the document and the other way round. So a question is found with
other numbers or names too, but not by the mere form of its sentences. Beside
the templates all windows of the bare words in lower case are joined, so a copy
in other case, or one of mostly numbers and names, matches too.

The benchmark's windows are broadcast, in blocks of bounded size; every block is
one pass over the documents, which are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramspan.llm.common import texts
from gramspan.llm.hashing import Block, Rolling, blocks, mix, signed

# Tokens of a window, and how many of them must be words.
WINDOW, LITERAL = 10, 5
# Matching windows on one alignment; an item with fewer must match with all.
RUN = 4
# Tokens below which an item has no window at all.
SHORTEST = 5
# Bytes of benchmark text in a block.
BENCH_BYTES = 8 << 20

WORD, NUMBER, NAME, UNIT = 0, 1, 2, 3
# Units that make a slot after a number.
UNITS = (
    "% percent mm cm m km in ft yd mi inches feet yards miles meters metres kilometers kilometres mg g kg t oz lb lbs "
    "grams kilograms pounds tons ml cl l liters litres gallons s sec min h hr hrs seconds minutes hours days weeks "
    "months years mph kph km/h w kw kwh v a hz c f k degrees usd eur gbp dollars cents euros pounds yen"
).split()

_PLACEHOLDER = mix(np.arange(101, 105, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FOLDED = np.uint64(0xA3B195354A39B70D)
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[np.frombuffer(b"!\"#$&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8)] = True
_ENDS = np.zeros(256, bool)
_ENDS[np.frombuffer(b".!?", np.uint8)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _lower(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals of UTF-8 bytes in lower case."""
    out = _LOWER[data]
    second = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    out[1:][second] += 32
    return out


def _unit_hashes() -> np.ndarray:
    block = Block([" ".join(UNITS).encode()])
    block.words()
    return np.unique(block.word_hashes())


class Canonical:
    """Canonical tokens of a block of texts: ``token``, ``value``, ``kind``, ``owner``."""

    def __init__(self, body: list[bytes]):
        block = Block(body)
        block.words()
        data, start, end = block.bytes, block.start.copy(), block.end.copy()
        last = data[np.maximum(end - 1, 0)] if len(end) else data[:0]
        # A sentence begins a text or line, or follows a word with final punctuation.
        breaks = np.zeros(len(data) + 1, np.int64)
        np.cumsum(data == 10, out=breaks[1:])
        opens = np.ones(len(start), bool)
        opens[1:] = (breaks[start[1:]] != breaks[start[:-1]]) | _ENDS[last[:-1]]
        signs = start.copy()
        while True:
            move = (start < end) & _PUNCTUATION[data[np.minimum(start, len(data) - 1)]]
            if not move.any():
                break
            start[move] += 1
        while True:
            move = (start < end) & _PUNCTUATION[data[end - 1]]
            if not move.any():
                break
            end[move] -= 1
        keep = np.flatnonzero(start < end)
        # A sentence also opens after a dropped token that ended one.
        carry = np.maximum.accumulate(np.where(opens, np.arange(len(opens)), -1)) if len(opens) else opens
        start, end, signs, owner = start[keep], end[keep], signs[keep], block.owner[keep]
        before = np.append(-1, keep[:-1]) if len(keep) else keep
        opens = carry[keep] > before if len(keep) else np.zeros(0, bool)
        low = _lower(data)
        shadow = Block.__new__(Block)
        shadow.bytes, shadow.start, shadow.end = low, start, end
        value = shadow.word_hashes()
        lead = data[start] if len(start) else data[:0]
        number = (lead >= 48) & (lead <= 57)
        second = data[np.minimum(start + 1, len(data) - 1)] if len(start) else data[:0]
        capital = ((lead >= 65) & (lead <= 90)) | ((lead == 0xC3) & (second >= 0x80) & (second <= 0x9E))
        unit = np.zeros(len(value), bool)
        if len(value):
            unit[1:] = np.isin(value[1:], _unit_hashes()) & number[:-1] & (owner[1:] == owner[:-1])
        self.kind = np.where(number, NUMBER, np.where(unit, UNIT, np.where(capital & ~opens, NAME, WORD))).astype(np.int8)
        self.value, self.owner = value, owner
        self.token = np.where(self.kind == WORD, value, _PLACEHOLDER[self.kind])
        self.first = np.searchsorted(owner, np.arange(len(body) + 1))

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows with enough words in one text."""
        n = len(self.token) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        words = np.zeros(len(self.kind) + 1, np.int64)
        np.cumsum(self.kind == WORD, out=words[1:])
        need = -(-LITERAL * length // WINDOW)
        good = (self.owner[:n] == self.owner[length - 1 :]) & (words[length:] - words[:n] >= need)
        at = np.flatnonzero(good)
        return at, mix(Rolling(self.token).windows(length)[at] + np.uint64(length))

    def folded(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of all windows in one text, of values without placeholders."""
        n = len(self.value) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.owner[:n] == self.owner[length - 1 :])
        return at, mix(Rolling(self.value).windows(length)[at] + _FOLDED + np.uint64(length))

    def embedded(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The first window of one text as it is inside a sentence, its first word a name."""
        inside = Canonical.__new__(Canonical)
        inside.kind, inside.token, inside.owner = self.kind[:length].copy(), self.token[:length].copy(), self.owner[:length]
        if self.kind[0] == WORD:
            inside.kind[0], inside.token[0] = NAME, _PLACEHOLDER[NAME]
        return inside.windows(length)


_ITEM = (
    "item_id long, length int, n int, at array<int>, w array<long>, fold_at array<int>, fold array<long>, "
    "inside array<long>, value array<long>, kind array<tinyint>"
)


def _items(benchmark: DataFrame) -> DataFrame:
    """The windows and slots of each item that is long enough."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, body in blocks(batch):
                ids = part.column(0).to_pylist()
                rows = []
                for item, text in zip(ids, body, strict=True):
                    c = Canonical([text])
                    length = min(len(c.token), WINDOW)
                    if length >= SHORTEST:
                        at, w = c.windows(length)
                        fold_at, fold = c.folded(length)
                        rows.append(
                            {
                                "item_id": item,
                                "length": length,
                                "n": len(at),
                                "at": at.tolist(),
                                "w": w.view(np.int64).tolist(),
                                "fold_at": fold_at.tolist(),
                                "fold": fold.view(np.int64).tolist(),
                                "inside": c.embedded(length)[1].view(np.int64).tolist(),
                                "value": c.value.view(np.int64).tolist(),
                                "kind": c.kind.tolist(),
                            }
                        )
                yield pa.RecordBatch.from_pylist(
                    rows,
                    pa.schema(
                        [
                            ("item_id", pa.int64()),
                            ("length", pa.int32()),
                            ("n", pa.int32()),
                            ("at", pa.list_(pa.int32())),
                            ("w", pa.list_(pa.int64())),
                            ("fold_at", pa.list_(pa.int32())),
                            ("fold", pa.list_(pa.int64())),
                            ("inside", pa.list_(pa.int64())),
                            ("value", pa.list_(pa.int64())),
                            ("kind", pa.list_(pa.int8())),
                        ]
                    ),
                )

    return texts(benchmark.filter("item_id is not null"), "item_id").mapInArrow(read, _ITEM)


def longest_run(places) -> int:
    """Most consecutive numbers among ``places``."""
    at = np.sort(np.fromiter(places, np.int64, len(places)))
    if not len(at):
        return 0
    return int(np.diff(np.flatnonzero(np.append(np.append(True, np.diff(at) != 1), True))).max())


def _restored(state: dict) -> Index:
    """The index of plain values that were sent to a worker; it needs no copy of this package."""
    index = Index.__new__(Index)
    index.__dict__.update(state)
    return index


class Index:
    """The windows of a block of benchmark items, to look documents' windows up in."""

    def __init__(self, rows: list):
        self.items = [
            (r["item_id"], r["n"], len(r["fold"]), np.array(r["value"]), np.array(r["kind"], np.int8)) for r in rows
        ]
        # Where a hash occurs: item, place, and whether it is of template, folded or first word in a sentence.
        self.places = defaultdict(list)
        for i, r in enumerate(rows):
            for how, at, hashes in ((0, r["at"], r["w"]), (1, r["fold_at"], r["fold"]), (2, [0], r["inside"])):
                for q, w in zip(at, hashes, strict=False):
                    self.places[w].append((i, q, how))
        self.places = dict(self.places)
        self.hashes = np.array(sorted(self.places), np.int64)
        self.lengths = sorted({r["length"] for r in rows})
        self.marks = np.zeros(1 << 20, bool)
        self.marks[self.hashes & 0xFFFFF] = True

    def known(self, w: np.ndarray) -> np.ndarray:
        """Positions of the hashes that the benchmark has."""
        w = w.view(np.int64)
        near = np.flatnonzero(self.marks[w & 0xFFFFF])
        return near[np.isin(w[near], self.hashes)]

    def leaks(self, body: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """``text, item_id, windows, slots, changed`` of each leak, the longest alignment of each pair."""
        c = Canonical(body)
        runs = defaultdict(set)
        templates, verbatim = defaultdict(set), defaultdict(set)
        for length in self.lengths:
            for at, w in (c.windows(length), c.folded(length)):
                hit = self.known(w)
                for p, h in zip(at[hit].tolist(), w[hit].view(np.int64).tolist(), strict=True):
                    for item, q, how in self.places[h]:
                        if how == 2 and int(c.value[p].view(np.int64)) != self.items[item][3][0]:
                            continue
                        run = int(c.owner[p]), item, p - q
                        runs[run].add((q, length))
                        (verbatim if how == 1 else templates)[run].add(q)
        best = {}
        for (text, item, shift), windows in runs.items():
            item_id, n, n_folded, value, kind = self.items[item]
            form = templates.get((text, item, shift), ())
            if not (n and len(form) >= min(RUN, n)) and len(windows) < min(RUN, n_folded):
                continue
            tokens = sorted({q + i for q, length in windows for i in range(length)})
            there, back, changed, slots, consistent = {}, {}, 0, 0, True
            for q in tokens:
                if kind[q] == WORD:
                    continue
                a, b = int(value[q]), int(c.value[q + shift].view(np.int64))
                slots += 1
                changed += a != b
                if there.setdefault((kind[q], a), b) != b or back.setdefault((kind[q], b), a) != a:
                    consistent = False
            # Slots are judged where a text is a new version of an item; a long part word for word is a leak by itself.
            if consistent or longest_run(verbatim.get((text, item, shift), ())) >= min(RUN, n_folded):
                got = (len(windows), -changed, slots)
                best[text, item_id] = max(best.get((text, item_id), got), got)
        return [(t, item, n, slots, -changed) for (t, item), (n, changed, slots) in best.items()]


def _indexes(benchmark: DataFrame) -> Iterator[Index]:
    """The benchmark in blocks of bounded size."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    parts = size // BENCH_BYTES + 1
    items = _items(benchmark)
    for part in range(parts):
        mine = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        yield Index(mine.orderBy("item_id").collect())


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, windows, slots, changed``: a row for each document and item it leaks.

    ``changed`` of ``slots`` have another value than in the item; 0 is a verbatim
    copy up to case and punctuation. The slots of a changed text must have one value
    each for every value of the item, unless ``RUN`` windows in a row are word for word the item's. Null and empty texts leak nothing, nor do
    items with fewer than ``SHORTEST`` tokens, null items and items without id;
    an item with too few words is found with its own values only. Repeated rows and repeated items give repeated rows. Extra
    columns are ignored; an empty table gives no rows.
    """
    out = None
    for index in _indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(vars(index))

        def read(batches, shared=shared) -> Iterator[pa.RecordBatch]:
            names = ["doc_id", "item_id", "windows", "slots", "changed"]
            index = _restored(shared.value)
            for batch in batches:
                for part, body in blocks(batch):
                    found = index.leaks(body)
                    if found:
                        text, *rest = (pa.array(x, pa.int64()) for x in zip(*found, strict=True))
                        yield pa.RecordBatch.from_arrays([part.column(0).take(text), *rest], names)

        schema = "doc_id long, item_id long, windows long, slots long, changed long"
        found = texts(docs).mapInArrow(read, schema)
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a leak, with all their columns; no row is moved."""
    for index in _indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(vars(index))

        @F.pandas_udf("boolean")
        def clean(text: pd.Series) -> pd.Series:
            batch = pa.record_batch([pa.array(text, pa.binary())], ["text"])
            parts, index = [], _restored(shared.value)
            for _, body in blocks(batch):
                ok = np.ones(len(body), bool)
                ok[[t for t, *_ in index.leaks(body)]] = False
                parts.append(ok)
            return pd.Series(np.concatenate(parts) if parts else np.ones(0, bool))

        docs = docs.filter(clean(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    return docs
