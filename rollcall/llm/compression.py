"""Quality rules by compression bands.

How far zstandard shrinks a text says whether it repeats itself (far) or is no language
at all (hardly). Both limits depend on the length, since a short text has little to
repeat and pays for the frame. Whole documents and fixed chunks are measured, so that a
long clean text cannot hide a repetitive half, nor the other way round.

The limits come from the corpus: the shortest interval that holds half of the ratios among
distinct texts of like length that pass the base rule, widened by a multiple of its width.
Unlike quartiles it stays where the clean texts are until the others are half. Where few
texts have a length, texts of neighbouring lengths count too; and wide fixed bands are
mixed in everywhere, with a weight that decides where there is next to nothing else.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.words import (
    Words, buffers, covered, lines_of, repeats_in_groups, rolling, small, span_hashes, sums, windows, words_of,
)

#: From so many bytes on, the least and the largest share that compression may leave, as far
#: as is known without a corpus.
BANDS = (
    (0, 0.0, 99.0),
    (256, 0.30, 0.95),
    (512, 0.28, 0.85),
    (1024, 0.26, 0.78),
    (2048, 0.25, 0.74),
    (4096, 0.24, 0.70),
    (8192, 0.23, 0.68),
    (16384, 0.20, 0.66),
    (262144, 0.15, 0.65),
)


@dataclass(frozen=True)
class Rules:
    """Parameters of the operator."""

    bands: Sequence[tuple[int, float, float]] = BANDS
    #: Bands of chunks, where they are others than those of whole texts.
    chunk_bands: Sequence[tuple[int, float, float]] | None = None
    #: Bytes of a chunk; the rest of a text, when shorter, is judged by the band of its length.
    chunk: int = 2048
    #: Length classes for each doubling of the length; shorter texts are not judged by ratio.
    classes: int = 4
    shortest: int = 256
    #: Limits lie so many widths of the shortest half below and above it, or ``margin`` if that is more.
    below: float = 1.5
    above: float = 2.0
    margin: float = 0.02
    #: Neighbouring classes are added on either side until a class has so many distinct texts.
    least: int = 100
    #: With so many texts the fixed bands weigh as much as the corpus, with ``k`` times as many ``1 / k**2`` of it.
    prior: int = 10
    #: Share of a text's bytes that may lie in chunks outside their band.
    bad_share: float = 0.3
    level: int = 3
    min_words: int = 50
    #: Per cent of the words that may lie in repeated windows.
    repeat_percent: int = 50
    window: int = 3
    symbols: str = "#*$%&|<>"


SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, ratio double, bad_chunk_share double, reason string"
)


def quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Counts and verdict of each document: one row per input row, in no order.

    Needs ``doc_id`` and ``text``; other columns are not read. A null or empty text has
    no words, so it fails the base rule; so does a text of spaces only. Repeated rows are
    judged alike, a null id stays null. ``ratio`` is compressed by raw bytes, null for an
    empty text. ``reason`` is null for kept documents, else the first of ``base``,
    ``repetitive``, ``incompressible``, ``repetitive chunks``, ``incompressible chunks``.

    Texts are read twice, for the bands and for the verdicts, and judged where they are
    read; only a hash and a ratio of each text and chunk are shuffled. Memory is that of one
    piece of 4 MB of texts, or of one longer text.
    """
    rules = fitted(docs, rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=rules.level, write_content_size=False).compress
        for batch in small(batches):
            yield _judge(batch, rules, compress)

    return docs.select("doc_id", "text").mapInArrow(judge, SCHEMA)


def _duplicate_lines(words: Words, offsets: np.ndarray) -> np.ndarray:
    starts, ends, doc = lines_of(words, offsets)
    _, later = repeats_in_groups(span_hashes(words.data, starts, ends), doc)
    return np.bincount(doc[later], minlength=len(offsets) - 1)


def _base(column: pa.Array, rules: Rules) -> dict[str, np.ndarray]:
    data, offsets = buffers(column)
    words = words_of(column)
    zeros = np.zeros(len(offsets) - 1, dtype=np.int64)
    if not len(words.starts):
        return {k: zeros for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    character = (data & 0xC0) != 0x80
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    symbol = np.zeros(256, dtype=bool)
    symbol[list(rules.symbols.encode())] = True

    at, doc = windows(words, rules.window)
    grams = rolling(words.hashes(), at, at + rules.window)
    twice, _ = repeats_in_groups(grams, doc)
    repeated = covered(at[twice], rules.window, len(words.starts))
    return {
        "n_words": words.counts,
        "word_chars": sums(character & ~blank, offsets),
        "n_symbols": sums(symbol[data], offsets),
        "n_dup_lines": _duplicate_lines(words, offsets),
        "n_repeat_words": sums(repeated, words.first),
    }


def good_rows(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; nothing is joined."""
    rules = fitted(docs, rules)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=rules.level, write_content_size=False).compress
        for batch in small(batches):
            yield batch.filter(_judge(batch, rules, compress).column("kept"))

    return docs.mapInArrow(sift, docs.schema)


def _failed(base: dict[str, np.ndarray], rules: Rules) -> np.ndarray:
    return (base["n_words"] < rules.min_words) | (100 * base["n_repeat_words"] > rules.repeat_percent * base["n_words"])


def class_of(size: int, classes: int) -> int:
    return int(np.floor(classes * np.log2(size)))


def _measured(docs: DataFrame, rules: Rules) -> DataFrame:
    """``(whole, class, ratio, n)``: distinct texts and chunks past the base rule, ratios in thousandths."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=rules.level, write_content_size=False).compress
        for batch in small(batches):
            column = batch.column("text")
            data, offsets = buffers(column)
            good = np.flatnonzero(~_failed(_base(column, rules), rules))
            starts, ends, whole = [], [], []
            for a, b in zip(offsets[:-1][good].tolist(), offsets[1:][good].tolist()):
                cuts = [(c, min(c + rules.chunk, b)) for c in range(a, b, rules.chunk)] if b - a > rules.chunk else []
                pieces = [(x, y, i == 0) for i, (x, y) in enumerate([(a, b), *cuts]) if y - x >= rules.shortest]
                starts += [x for x, _, _ in pieces]
                ends += [y for _, y, _ in pieces]
                whole += [w for _, _, w in pieces]
            view = memoryview(np.ascontiguousarray(data))
            ratios = [round(1000 * len(compress(view[a:b])) / (b - a)) for a, b in zip(starts, ends)]
            kinds = [class_of(b - a, rules.classes) for a, b in zip(starts, ends)]
            hashes = [int.from_bytes(hashlib.blake2b(view[a:b], digest_size=8).digest(), "little", signed=True) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.int64()), pa.array(whole, pa.bool_()), pa.array(kinds, pa.int32()), pa.array(ratios, pa.int32())],
                names=["hash", "whole", "class", "ratio"],
            )

    found = docs.select("text").mapInArrow(measure, "hash bigint, whole boolean, class int, ratio int").distinct()
    return found.groupBy("whole", "class", "ratio").agg(F.count("*").alias("n"))


def shortest_half(values: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """The shortest interval with at least half of the weight; the middle one of several."""
    order = np.argsort(values, kind="stable")
    values, total = values[order], np.cumsum(weights[order])
    before = total - weights[order]
    end = np.searchsorted(total, before + total[-1] / 2 - 1e-9)
    inside = np.flatnonzero(end < len(values))
    width = values[end[inside]] - values[inside]
    best = inside[np.flatnonzero(width <= width.min() + 1e-9)]
    at = best[len(best) // 2]
    return float(values[at]), float(values[end[at]])


def _middle(size: int, bands: Sequence[tuple[int, float, float]]) -> float:
    """Middle of the fixed bands at a length, straight between those of the bands' own middle lengths."""
    starts = [max(b[0], 1) for b in bands]
    at = [np.log2(a) + (np.log2(b) - np.log2(a)) / 2 for a, b in zip(starts, [*starts[1:], 2 * starts[-1]])]
    inner = [(x, (low + high) / 2) for x, (_, low, high) in zip(at, bands) if high <= 1]
    return float(np.interp(np.log2(max(size, 1)), [x for x, _ in inner], [y for _, y in inner])) if inner else 0.5


def fences(counts: dict[int, dict[int, int]], rules: Rules) -> tuple[tuple[int, float, float], ...]:
    """Bands for the classes, from the number of texts by class and ratio in thousandths.

    Ratios of a neighbouring class are moved by as much as the middles of the fixed bands differ,
    which fall with the length as those of texts do.
    """
    out = {start: (low, high) for start, low, high in rules.bands}
    size_of = lambda kind: int(np.ceil(2 ** (kind / rules.classes)))
    middle = {k: _middle(size_of(k), rules.bands) for k in counts}
    for kind in sorted(counts):
        width, near = 0, {kind}
        while sum(sum(counts[k].values()) for k in near) < rules.least and len(near) < len(counts):
            width += 1
            near = {k for k in counts if abs(k - kind) <= width}
        found = [(ratio / 1000 + middle[kind] - middle[k], n) for k in sorted(near) for ratio, n in sorted(counts[k].items())]
        weights = np.array([n for _, n in found], dtype=float)
        first, last = shortest_half(np.array([r for r, _ in found]), weights)
        # The shortest half that widens to the fixed band; it weighs less, the more texts there are.
        low, high = limits(size_of(kind), rules.bands)
        width = (high - low) / (1 + rules.below + rules.above)
        assumed = middle[kind] - (high - low) / 2 + rules.below * width
        told = weights.sum() ** 2 / (weights.sum() ** 2 + rules.prior**2)
        first = told * first + (1 - told) * assumed
        last = told * last + (1 - told) * (assumed + width)
        after = size_of(kind + 1)
        out.setdefault(after, limits(after, rules.bands))
        out[size_of(kind)] = (first - max(rules.below * (last - first), rules.margin), last + max(rules.above * (last - first), rules.margin))
    return tuple((start, *out[start]) for start in sorted(out))


def fitted(docs: DataFrame, rules: Rules) -> Rules:
    """The rules with bands of the corpus; at most a row for each length class and thousandth comes to the driver."""
    counts: dict[bool, dict[int, dict[int, int]]] = {True: {}, False: {}}
    for r in _measured(docs, rules).collect():
        counts[r.whole].setdefault(r["class"], {})[r.ratio] = r.n
    return replace(rules, bands=fences(counts[True], rules), chunk_bands=fences(counts[False], rules))


def limits(size: int, bands: Sequence[tuple[int, float, float]]) -> tuple[float, float]:
    """Least and largest ratio for a text of so many bytes."""
    at = bisect_right(bands, size, key=lambda band: band[0])
    return bands[at - 1][1:] if at else (0.0, float("inf"))


def _verdict(text: memoryview, rules: Rules, compress) -> tuple[float | None, float, str | None]:
    """Ratio, share of bytes in bad chunks, reason."""
    size = len(text)
    if not size:
        return None, 0.0, None
    ratio = len(compress(text)) / size
    low, high = limits(size, rules.bands)
    low_bytes = high_bytes = 0
    for at in range(0, size, rules.chunk):
        piece = text[at : at + rules.chunk]
        alone = len(piece) == size
        least, most = (low, high) if alone else limits(len(piece), rules.chunk_bands or rules.bands)
        left = ratio if alone else len(compress(piece)) / len(piece)
        low_bytes += len(piece) * (left < least)
        high_bytes += len(piece) * (left > most)
    share = (low_bytes + high_bytes) / size
    reason = None
    if ratio < low:
        reason = "repetitive"
    elif ratio > high:
        reason = "incompressible"
    elif share > rules.bad_share:
        reason = "repetitive chunks" if low_bytes >= high_bytes else "incompressible chunks"
    return ratio, share, reason


def _judge(batch: pa.RecordBatch, rules: Rules, compress) -> pa.RecordBatch:
    column = batch.column("text")
    base = _base(column, rules)
    failed = _failed(base, rules)
    data, offsets = buffers(column)
    view = memoryview(np.ascontiguousarray(data))
    found = [_verdict(view[a:b], rules, compress) for a, b in zip(offsets[:-1], offsets[1:])]
    reasons = ["base" if bad else reason for bad, (_, _, reason) in zip(failed, found)]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").cast(pa.int64()),
            *[pa.array(base[k], pa.int64()) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
            pa.array(failed), pa.array([r is None for r in reasons]),
            pa.array([r for r, _, _ in found], pa.float64()), pa.array([s for _, s, _ in found], pa.float64()),
            pa.array(reasons, pa.string()),
        ],
        names=[c.strip().split(" ")[0] for c in SCHEMA.split(",")],
    )
