"""Words of whole texts as arrays, a batch of documents at a time.

A word is a run of bytes other than space and ``\\t\\n\\v\\f\\r``. These are single bytes
in UTF-8 and never part of a longer character, so texts are cut as bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: The same class for regular expressions of Spark, Python and DuckDB.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes hashed at a time; a longer text is cut between words.
SLAB = 1 << 21

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True

# A polynomial over odd bases modulo 2**64, whose inverse powers exist.
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse, as long as any batch has needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 16)
            up, down = np.full(size, _BASE), np.full(size, _INVERSE)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for each span; equal spans hash equally."""
    up, down = _POWERS.get(len(values) + 1)
    sums = np.empty(len(values) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(values.astype(np.uint64) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, spans in order; by slabs, so that memory stays small."""
    out = np.empty(len(starts), dtype=np.uint64)
    lo = 0
    while lo < len(out):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + SLAB)))
        a, b = starts[lo], ends[hi - 1]
        out[lo:hi] = rolling(data[a:b].astype(np.uint64) + np.uint64(1), starts[lo:hi] - a, ends[lo:hi] - a)
        lo = hi
    return out


@dataclass
class Words:
    """Words of a batch. ``first[d]:first[d + 1]`` are those of document ``d``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word."""
        return span_hashes(self.data, self.starts, self.ends)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array) -> Words:
    """The words of every text of a column."""
    data, offsets = buffers(column)
    if not len(data):
        none = np.empty(0, dtype=np.int64)
        return Words(data, none, none, np.zeros(len(offsets), dtype=np.int64))
    solid = ~_SPACE[data]
    before, after = np.empty_like(solid), np.empty_like(solid)
    before[0], before[1:] = False, solid[:-1]
    after[-1], after[:-1] = False, solid[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def positions(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for each group of the given sizes, one after the other."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def small(batches: Iterator[pa.RecordBatch], rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a piece has few rows and few bytes, or a single row."""
    for batch in batches:
        lo = 0
        while lo < batch.num_rows:
            n = min(rows, batch.num_rows - lo)
            while n > 1 and batch.slice(lo, n).nbytes > size:
                n = max(1, n // 2)
            yield batch.slice(lo, n)
            lo += n


def lines_of(words: Words, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each line that has a word; lines end at ``\\n``."""
    data = words.data
    starts = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 10) + 1]))
    ends = np.append(starts[1:], len(data))
    ends = np.where((ends > starts) & (data[np.maximum(ends, 1) - 1] == 10), ends - 1, ends) if len(data) else ends
    solid = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[solid], ends[solid]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def repeats_in_groups(keys: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key, whether its group holds it more than once, and whether this is not its first place."""
    pairs = np.stack([keys, group.astype(np.uint64)], axis=1).ravel()
    at = np.arange(0, len(pairs), 2)
    mixed = rolling(pairs, at, at + 2)
    order = np.argsort(mixed, kind="stable")
    ordered = mixed[order]
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    twice, later = np.empty(len(keys), dtype=bool), np.empty(len(keys), dtype=bool)
    twice[order], later[order] = same[1:] | same[:-1], same[:-1]
    return twice, later


def windows(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and document of each window of so many words within one document."""
    per_doc = np.maximum(words.counts - length + 1, 0)
    return np.repeat(words.first[:-1], per_doc) + positions(per_doc), np.repeat(np.arange(len(per_doc)), per_doc)


def covered(starts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which of ``total`` places lie in a window of ``length`` from one of ``starts``."""
    edges = np.zeros(total + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + length, -1)
    return np.cumsum(edges[:-1]) > 0


def sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values between neighbouring offsets."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
