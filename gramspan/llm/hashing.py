"""Vectorised hashing of words, byte windows and sliding minima.

Everything here works on one bounded block of texts at a time: the bytes of
the texts joined by newlines, and numpy arrays over them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

# Bytes of text that are hashed at a time; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD[0]))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(seed: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd constant and of its inverse modulo 2**64, at least ``size``."""
    if seed not in _POWERS or len(_POWERS[seed][0]) < size:
        odd = _ODD[seed]
        up = np.full(1 << size.bit_length(), odd, np.uint64)
        down = np.full(len(up), pow(odd, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[seed] = np.cumprod(up), np.cumprod(down)
    return _POWERS[seed]


class Rolling:
    """Polynomial hashes of any slice of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, seed: int = 0):
        up, self.down = powers(seed, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def windows(self, length: int) -> np.ndarray:
        """Hashes of all slices of ``length``, by their start."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[length:] - self.sums[:n]) * self.down[:n])


class Block:
    """Some texts as joined bytes. ``first[i]`` is where text ``i`` begins."""

    def __init__(self, texts: Sequence[bytes]):
        self.texts = texts
        self.joined = b"\n".join(texts) + b"\n"
        self.bytes = np.frombuffer(self.joined, np.uint8)
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.cumsum(self.lengths + 1) - self.lengths - 1

    def words(self) -> None:
        """Find the words: maximal runs of other bytes than ASCII space.

        Sets ``start`` and ``end`` (in ``joined``), ``owner`` (text of each
        word), ``word0`` and ``n_words`` (first word and word count per text).
        """
        gap = _SPACE[self.bytes]
        edge = np.flatnonzero(np.diff(gap, prepend=True))
        self.start, self.end = edge[0::2], edge[1::2]
        self.word0 = np.searchsorted(self.start, self.first)
        self.n_words = np.diff(np.append(self.word0, len(self.start)))
        self.owner = np.repeat(np.arange(len(self.texts)), self.n_words)

    def word_hashes(self) -> np.ndarray:
        values = _BYTE[self.bytes]
        return Rolling(values).slices(self.start, self.end) + (self.end - self.start).astype(np.uint64)

    def byte_values(self) -> np.ndarray:
        return _BYTE[self.bytes]


def blocks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut a batch into runs of rows with about ``BLOCK_BYTES`` of text."""
    texts = [t or b"" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]
    begin = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > BLOCK_BYTES:
            yield batch.slice(begin, i - begin), texts[begin:i]
            begin, held = i, 0
        held += len(t) + 1
    if begin < len(texts):
        yield batch.slice(begin), texts[begin:]


def sliding(values: np.ndarray, width: int, fold=np.minimum) -> np.ndarray:
    """Fold of every ``width`` consecutive values, by their start."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = fold(out[:-step], out[step:])
        have += step
    return out


def winnow(values: np.ndarray, width: int, valid: np.ndarray) -> np.ndarray:
    """Which values are the least of one of the valid runs of ``width``.

    ``valid`` says of each run, by its start, whether it counts. Equal runs
    select equal positions, so a run that occurs twice has a value selected
    at the same place in both.
    """
    chosen = np.zeros(len(values), bool)
    if len(valid) and valid.any():
        least = sliding(values, width)
        least[~valid] = 0
        pad = np.zeros(width - 1, np.uint64)
        most = sliding(np.concatenate([pad, least, pad]), width, np.maximum)
        chosen = (most == values) & (most > 0)
    return chosen


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())
