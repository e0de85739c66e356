"""Vector best-fit packing of tokenised documents into training sequences.

A sequence has a capacity of tokens, of pieces (the parts of documents in it) and
of attention cost (the sum of squared piece lengths). Pieces are placed by falling size into the
open sequence that fits under every capacity and has the least weighted norm of
what would be left, or the greatest weighted dot product of need and what is left.

Every task packs the pieces of its documents as it reads them, a bounded number at
a time. Sequences it cannot fill wait for more; those still open at its end
are taken apart, and their pieces, a small share of all, are dealt out and packed once more.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramspan.llm.common import stored, texts
from gramspan.llm.hashing import Block

# Pieces and tokens that a task packs together.
HOLD_PIECES, HOLD_TOKENS = 16_384, 4_000_000
# Different words whose ids a worker remembers, before it starts anew.
PARTS = 200_000
# Text that is tokenised together; a longer one alone.
TEXT_BYTES = 1 << 20
END = 1

PIECES = "doc_id long, piece int, start long, length long, ids binary"
PACKED = PIECES + ", sequence_id long, offset long"


@dataclass(frozen=True)
class Capacity:
    """What a sequence can hold. ``weights`` None: the mean need in each dimension."""

    tokens: int = 4096
    pieces: int = 4096
    attention: int = 4096 * 4096
    rule: str = "norm"
    weights: tuple[float, float, float] | None = None
    # Share of the tokens from which on a sequence is full enough to be written at once.
    settled: float = 0.99

    def __post_init__(self):
        if min(self.tokens, self.pieces, self.attention) < 1:
            raise ValueError("every capacity must be at least 1")
        if self.rule not in ("norm", "dot"):
            raise ValueError("rule must be 'norm' or 'dot'")

    @property
    def longest(self) -> int:
        """Tokens of the longest piece that fits into an empty sequence."""
        return min(self.tokens, isqrt(self.attention))

    @property
    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.pieces, self.attention], np.int64)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> np.ndarray:
    """Number of the sequence of each piece; ``lengths`` must fall."""
    limits = capacity.limits
    need = np.column_stack([lengths, np.ones_like(lengths), lengths * lengths]).astype(np.int64)
    weights = capacity.weights or (need / limits).mean(0)
    scale = np.asarray(weights, float) / limits.astype(float) ** 2
    left = np.zeros((len(lengths), 3), np.int64)
    name = np.zeros(len(lengths), np.int64)
    placed = np.empty(len(lengths), np.int64)
    least = int(lengths[-1]) if len(lengths) else 0
    open_ = made = 0
    for i, v in enumerate(need):
        rest = left[:open_] - v
        fits = (rest >= 0).all(1)
        at = np.flatnonzero(fits)
        if len(at):
            if capacity.rule == "norm":
                cost = (rest[at].astype(float) ** 2) @ scale
            else:
                cost = -(left[at].astype(float) @ (scale * v))
            j = at[cost.argmin()]
        else:
            j, made, open_ = open_, made + 1, open_ + 1
            left[j], name[j] = limits, made - 1
        left[j] -= v
        placed[i] = name[j]
        # Sequences into which not even the shortest piece fits are closed.
        if left[j, 0] < least or left[j, 1] < 1 or left[j, 2] < least * least:
            open_ -= 1
            left[j], name[j] = left[open_], name[open_]
    return placed


# --- tokens ------------------------------------------------------------------------

# Steps before the byte-pair model for which words can be cut and lower-cased
# here, in arrays: fixed values of the tokenizer's file.
_PLAIN_STEPS = {
    "normalizer": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
    "pre_tokenizer": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_LETTER, _DIGIT, _OTHER, _ODD = 1, 2, 3, 4


def _classes() -> np.ndarray:
    """Kind of each ASCII byte; an apostrophe, controls and all others need the tokenizer's own rules."""
    kind = np.full(256, _ODD, np.uint8)
    for c in range(33, 127):
        kind[c] = _LETTER if chr(c).isalpha() else _DIGIT if chr(c).isdigit() else _OTHER
    kind[ord("'")] = _ODD
    return kind


def _two_byte_letters() -> np.ndarray:
    """By code point, the lower case of Latin letters from U+00C0 to U+023F; 0 for what is none or gets longer."""
    lower = np.zeros(0x800, np.uint16)
    for c in range(0xC0, 0x240):
        low = chr(c).lower()
        if chr(c).isalpha() and len(low) == 1 and ord(low) < 0x800:
            lower[c] = ord(low)
    return lower


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in shown}
    table |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in table)}
    return table | {32: " "}


_KIND, _LOWER, _SHOWN = _classes(), _two_byte_letters(), _byte_characters()
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class WordEncoder:
    """Ids of whole texts, each different word encoded once.

    For tokenizers that never join text across ASCII white space and drop it.
    Where the file says that words are cut at changes between letters, digits and
    others, words of ASCII and Latin letters are cut and folded here, and only the
    byte-pair model sees the parts; the tokenizer itself takes all other words.
    """

    def __init__(self, spec: str):
        # Tasks already use every core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._forget()
        self.tokenizer = Tokenizer.from_str(spec)
        steps = json.loads(spec)
        self.plain = all(
            (steps[k] or {}).get("type") == "Sequence" and next(v for n, v in steps[k].items() if n != "type") == rule
            for k, rule in _PLAIN_STEPS.items()
        ) and steps["model"].get("end_of_word_suffix")
        if self.plain:
            self.model = Tokenizer.from_str(spec)
            self.model.normalizer = normalizers.Sequence([])
            self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for s, i in vocabulary.items() if s.endswith(self.plain)]] = True

    def _parts(self, block: Block) -> tuple[np.ndarray, ...]:
        """Bytes, starts and ends of the parts of words, which ones only the tokenizer can encode, first parts of words."""
        start, end = block.start, block.end
        if not self.plain:
            return block.bytes, start, end, np.ones(len(start), bool), np.arange(len(start))
        data = _FOLD[block.bytes]
        kind = _KIND[data]
        lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC8))
        low = _LOWER[((data[lead].astype(np.uint16) & 0x1F) << 6) | (data[lead + 1] & 0x3F)]
        lead, low = lead[low > 0], low[low > 0]
        data[lead], data[lead + 1] = 0xC0 | (low >> 6), 0x80 | (low & 0x3F)
        kind[lead] = kind[lead + 1] = _LETTER
        # Special tokens begin with these two characters.
        kind[np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))] = _ODD
        odd = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kind == _ODD, out=odd[1:])
        strange = odd[end] > odd[start]
        word = np.zeros(len(data) + 1, np.int64)
        np.add.at(word, start, 1)
        inside = np.repeat(strange, end - start)
        at = np.repeat(start - (np.cumsum(end - start) - (end - start)), end - start) + np.arange(len(inside))
        first = word[at] > 0
        cut = (kind[at] != kind[at - 1]) | (kind[at] == _DIGIT)
        mark = np.flatnonzero(first | (cut & ~inside))
        begins, first = at[mark], first[mark]
        # Words that are left to the tokenizer keep their case.
        data[at[inside]] = block.bytes[at[inside]]
        lead = np.flatnonzero(first)
        ends = np.append(begins[1:], 0)
        ends[np.append(lead[1:], len(begins)) - 1] = end
        return data, begins, ends, strange[np.cumsum(first) - 1], lead

    def encode(self, body: list[bytes]) -> list[np.ndarray]:
        """For each text, its ids and ``END``, as little-endian unsigned 32-bit numbers."""
        block = Block(body)
        block.words()
        if not len(block.start):
            return [np.array([END], "<u4")] * len(body)
        data, start, end, strange, part = self._parts(block)
        length = end - start
        ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        at = np.repeat(start - ends[:-1], length) + np.arange(ends[-1])
        buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[at].tobytes())]
        coded = pa.Array.from_buffers(pa.large_binary(), len(length), buffers).dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        different = coded.dictionary.to_pylist()
        asked = np.zeros(len(different), bool)
        asked[code] = strange
        place = self._places(different, asked)
        many, first = self.sizes[place][code], self.first[place][code]
        upto = np.cumsum(many)
        flat = self.ids[np.repeat(first - (upto - many), many) + np.arange(upto[-1])]
        cuts = np.concatenate([[0], upto])[np.append(part, len(code))[np.append(block.word0, len(part))]]
        flat = np.insert(flat, cuts[1:], END).astype("<u4")
        cuts += np.arange(len(cuts))
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _places(self, parts: list[bytes], asked: np.ndarray) -> np.ndarray:
        """Where the ids of different parts are kept; those of new ones are found first."""
        if len(self.known) > PARTS:
            self._forget()
        place = np.fromiter((self.known.get(p, -1) for p in parts), np.int64, len(parts))
        new = np.flatnonzero(place < 0)
        if len(new):
            ids, sizes = self._different([parts[i] for i in new], asked[new])
            self.first = np.append(self.first, len(self.ids) + np.cumsum(sizes) - sizes)
            self.ids, self.sizes = np.append(self.ids, ids), np.append(self.sizes, sizes)
            place[new] = len(self.known) + np.arange(len(new))
            self.known.update(zip((parts[i] for i in new), place[new].tolist(), strict=True))
        return place

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.first, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _different(self, parts: list[bytes], asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different parts one after another, and how many each has."""
        own = np.flatnonzero(asked)
        found = self.tokenizer.encode_batch_fast(
            [parts[i].decode("utf-8", "replace") for i in own], add_special_tokens=False
        )
        found = [np.array(e.ids, np.uint32) for e in found]
        sizes = np.zeros(len(parts), np.int64)
        sizes[own] = [len(f) for f in found]
        rest = np.flatnonzero(~asked)
        plain = np.zeros(0, np.uint32)
        if len(rest):
            text = b" ".join(parts[i] for i in rest).decode("latin-1").translate(_SHOWN)
            plain = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            last = np.flatnonzero(self.last[plain])
            if len(last) != len(rest):
                raise ValueError("the tokenizer does not end every word")
            sizes[rest] = np.diff(last, prepend=-1)
        out = np.empty(sizes.sum(), np.uint32)
        mine = np.repeat(asked, sizes)
        out[~mine] = plain
        out[mine] = np.concatenate([*found, np.zeros(0, np.uint32)])
        return out, sizes


def _pieces(doc, ids: np.ndarray, longest: int) -> Iterator[tuple]:
    for piece, start in enumerate(range(0, len(ids), longest)):
        part = ids[start : start + longest]
        yield doc, piece, start, len(part), part.tobytes()


# --- packing -----------------------------------------------------------------------


@dataclass
class Packer:
    """Packs a stream of pieces; ``first`` numbers its sequences."""

    capacity: Capacity
    first: int
    held: list[tuple] = field(default_factory=list)
    tokens: int = 0

    def add(self, row: tuple) -> Iterator[list[tuple]]:
        if row[3] == self.capacity.tokens:
            yield self._numbered([row])
            return
        self.held.append(row)
        self.tokens += row[3]
        if len(self.held) >= HOLD_PIECES or self.tokens >= HOLD_TOKENS:
            yield from self._write(self._sequences(), keep=True)

    def rest(self, last: bool) -> Iterator[list[tuple]]:
        """Write what is held; unless ``last``, pieces of sequences with room get none."""
        waiting = self._sequences()
        if last:
            yield from self._write(waiting, keep=False)
            return
        yield from self._write(waiting, keep=True)
        for row in self.held:
            yield [(*row, None, None)]

    def _sequences(self) -> list[list[tuple]]:
        rows = sorted(self.held, key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[4]))
        self.held, self.tokens = [], 0
        number = best_fit(np.array([r[3] for r in rows], np.int64), self.capacity)
        out: list[list[tuple]] = [[] for _ in range(int(number.max(initial=-1)) + 1)]
        for r, k in zip(rows, number.tolist(), strict=True):
            out[k].append(r)
        return out

    def _write(self, sequences: list[list[tuple]], keep: bool) -> Iterator[list[tuple]]:
        """The full sequences; with ``keep`` the others wait, while they are less than half a load."""
        sequences.sort(key=lambda s: -sum(r[3] for r in s))
        waiting = len(sequences)
        if keep:
            full = self.capacity.tokens * self.capacity.settled
            pieces = tokens = 0
            for s in reversed(sequences):
                size = sum(r[3] for r in s)
                pieces, tokens = pieces + len(s), tokens + size
                if size >= full or len(s) >= self.capacity.pieces:
                    break
                if 2 * pieces > HOLD_PIECES or 2 * tokens > HOLD_TOKENS:
                    break
                waiting -= 1
        for s in sequences[:waiting]:
            yield self._numbered(s)
        self.held = [r for s in sequences[waiting:] for r in s]
        self.tokens = sum(r[3] for r in self.held)

    def _numbered(self, rows: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for r in rows:
            out.append((*r, self.first, offset))
            offset += r[3]
        self.first += 1
        return out


_NAMES = [f.split(" ")[0] for f in PACKED.split(", ")]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[bytes]]]:
    """Runs of rows with about ``TEXT_BYTES`` of text."""
    upto = np.cumsum(pc.binary_length(batch.column(1)).to_numpy().astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff((upto - 1) // TEXT_BYTES)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a < b:
            yield tuple(c.to_pylist() for c in batch.slice(a, b - a).columns)


def _batches(sequences: Iterator[list[tuple]]) -> Iterator[pa.RecordBatch]:
    """Rows of sequences as batches of a few MB."""
    rows, size = [], 0
    for s in sequences:
        rows += s
        size += sum(len(r[4]) for r in s)
        if size > 1 << 22 or len(rows) > 4096:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(columns, _NAMES)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: Capacity | None = None) -> DataFrame:
    """Tokenise ``doc_id, text`` with the file ``tokenizer`` and pack all documents.

    Returns ``doc_id, piece, start, length, ids, sequence_id, offset``, a row per
    piece: ``ids`` are its tokens as little-endian unsigned 32-bit numbers, ``start`` is its place
    in the document and ``offset`` in the sequence. Only documents longer than the
    longest piece are cut. A document is its ids and the id ``END``, so a null,
    empty or blank text is one token. Rows that share a doc_id, or have none, are
    documents of their own; equal rows are each packed. An empty table packs to none.
    Extra columns are ignored. The file is read once, here, and sent to the workers.
    """
    capacity = capacity or Capacity()
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def read(batches) -> Iterator[pa.RecordBatch]:
        def sequences():
            encoder = WordEncoder(spec.value)
            packer = Packer(capacity, TaskContext.get().partitionId() << 32)
            for batch in batches:
                for docs_, body in _blocks(batch):
                    for doc, ids in zip(docs_, encoder.encode(body), strict=True):
                        for row in _pieces(doc, ids, capacity.longest):
                            yield from packer.add(row)
            yield from packer.rest(last=False)

        yield from _batches(sequences())

    done = stored(texts(docs).mapInArrow(read, PACKED), "packing-pieces")
    rest = done.filter("sequence_id is null").select(*PIECES_NAMES)
    size = rest.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("t")).head()
    if not size["n"]:
        return done
    # One load for each task, without waiting for more.
    tasks = max(-(-2 * size["n"] // HOLD_PIECES), -(-2 * size["t"] // HOLD_TOKENS))
    return done.filter("sequence_id is not null").unionByName(pack_pieces(rest, capacity, tasks))


def pack_pieces(rest: DataFrame, capacity: Capacity, tasks: int) -> DataFrame:
    """Pack pieces dealt out evenly to ``tasks`` tasks, each to its end."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        def sequences():
            packer = Packer(capacity, (1 << 62) + (TaskContext.get().partitionId() << 32))
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield from packer.add(row)
            yield from packer.rest(last=True)

        yield from _batches(sequences())

    return rest.repartition(tasks).mapInArrow(read, PACKED)


PIECES_NAMES = [f.split(" ")[0] for f in PIECES.split(", ")]
