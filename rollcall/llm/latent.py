"""Benchmark items found in documents by latent semantic retrieval.

TF-IDF vectors of passages are projected on the leading singular directions of a randomised
SVD. Passages of a document overlap, one begins every few words, and each item is laid out
in passages one after the other, so that a copy meets them but for a word wherever it stands,
with sentence ends or without. Passages close to one of an item are candidates. What the projection only
finds alike is then compared word by word: by longest common subsequence, and by whether the
answer of the item is there.

A passage of a document that shares too few words with all items together is not projected:
the comparison word by word would turn it down anyway. Items shorter than a passage have no
vector that tells them apart; only for them every word is looked up among their rarest ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.words import Words, positions, small, span_hashes, words_of
from rollcall.session import pin


@dataclass(frozen=True)
class Settings:
    """Parameters of the index and of the checks."""

    #: Words are hashed into so many terms.
    terms: int = 8192
    #: Words of a passage.
    words: int = 12
    #: The directions are fitted on passages that end a sentence, or after so many words.
    longest: int = 24
    rank: int = 64
    oversample: int = 8
    iterations: int = 2
    #: The directions are fitted on documents of about so many bytes in all, chosen by a hash;
    #: document frequencies count every passage, and every passage is searched.
    fit_bytes: int = 16 << 20
    #: Least cosine of a candidate, and words its passage shares in order with the item's.
    cosine: float = 0.75
    shared: int = 7
    #: Rare words of a short item looked up beyond those a leak may lack; so many must be found.
    rare: int = 4
    #: A passage of a document begins at every ``step``-th word; one that is a word off is still close.
    step: int = 3
    #: Words of documents projected at a time.
    slab: int = 4096
    #: Words looked up at a time, times the items that have them.
    places: int = 1 << 21
    #: Share of an item's words that a document holds in order: enough alone, or with the answer.
    whole: float = 0.8
    partial: float = 0.6
    answer: float = 0.8
    #: Benchmark items searched in one pass; more items are more passes.
    items: int = 20_000
    seed: int = 42


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STOPS, _TRAILING = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_STOPS[list(b".!?")] = True
_TRAILING[list(b".,;:!?\"')")] = True


def _normal(column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, their hashes in lower case without a trailing mark, and which end a sentence."""
    words = words_of(column)
    if not len(words.starts):
        return words, np.empty(0, np.uint64), np.empty(0, bool)
    last = words.data[words.ends - 1]
    ends = words.ends - (_TRAILING[last] & (words.ends - words.starts > 1))
    return words, span_hashes(_LOWER[words.data], words.starts, ends), _STOPS[last]


def _passages(words: Words, stops: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """First word of each passage, and the word after its last one; every word is in a passage.

    A passage shorter than ``words`` takes words of its document before it.
    """
    total = len(words.starts)
    if not total:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    final = words.first[1:][words.counts > 0] - 1
    ends = stops.copy()
    ends[final] = True
    at = np.flatnonzero(ends)
    before = np.append(-1, at[:-1])
    runs = at - before
    extra = (runs - 1) // settings.longest
    forced = np.repeat(before, extra) + settings.longest * (np.arange(int(extra.sum())) - np.repeat(np.cumsum(extra) - extra, extra) + 1)
    ends[forced] = True
    after = np.flatnonzero(ends) + 1
    begin = np.minimum(np.append(0, after[:-1]), after - settings.words)
    return np.maximum(begin, words.first[np.searchsorted(words.first, after - 1, side="right") - 1]), after


def _terms_of(column: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The terms of all passages, one passage after the other, and how many each has."""
    words, hashes, stops = _normal(column)
    begin, after = _passages(words, stops, settings)
    terms, counts = (hashes % np.uint64(settings.terms)).astype(np.int32), after - begin
    return terms[np.repeat(begin, counts) + positions(counts)], counts


def _document_frequencies(docs: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """Passages that hold each term, and all passages: every passage counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(settings.terms + 2, dtype=np.int64)
        for batch in small(batches, rows=1024):
            terms, counts = _terms_of(batch.column("text"), settings)
            # Sorted by passage, then by term, of which the first one counts.
            keys = np.sort(np.repeat(np.arange(len(counts)) * settings.terms, counts) + terms)
            again = np.zeros(len(keys), dtype=bool)
            again[1:] = keys[1:] == keys[:-1]
            seen[:-1] += np.bincount(keys[~again] % settings.terms, minlength=settings.terms + 1)
            seen[-1] += len(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(seen))), pa.array(seen)], names=["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(settings.terms + 2, dtype=np.int64)
    for r in rows:  # as many rows as terms
        seen[r.term] = r.n
    return seen[: settings.terms], int(seen[-1])


def _weighted(idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Projection of each term, with a last row for "no word"."""
    return np.vstack([basis * idf[:, None], np.zeros((1, basis.shape[1]))]).astype(np.float32)


def _embedded(terms: np.ndarray, projection: np.ndarray) -> np.ndarray:
    out = np.zeros((len(terms), projection.shape[1]), dtype=np.float32)
    for j in range(terms.shape[1]):
        out += projection[terms[:, j]]
    return out


def _summed(terms: np.ndarray, begins: np.ndarray, counts: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Sum of the projected terms of each passage, the longest passages first while it adds up."""
    order = np.argsort(-counts, kind="stable")
    starts, longer = begins[order], len(counts) - np.searchsorted(counts[order[::-1]], np.arange(counts.max(initial=0)), side="right")
    out = np.zeros((len(counts), projection.shape[1]), dtype=np.float32)
    for j, n in enumerate(longer.tolist()):
        out[:n] += projection[terms[starts[:n] + j]]
    back = np.empty_like(out)
    back[order] = out
    return back


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _applied(sample: DataFrame, idf: np.ndarray, basis: np.ndarray, settings: Settings) -> np.ndarray:
    """``A^T A basis`` for the matrix A of unit TF-IDF rows; summed up by blocks of terms in Spark."""
    width, block, kind = basis.shape[1], 512, np.min_scalar_type(settings.terms)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((settings.terms, width))
        squares, projection = idf**2, _weighted(idf, basis)
        for batch in batches:
            terms = np.frombuffer(b"".join(batch.column("terms").to_pylist()), dtype=np.int32)
            counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), dtype=np.int64)
            first = np.append(0, np.cumsum(counts))
            for lo in range(0, len(counts), 1 << 13):
                n = counts[lo : lo + (1 << 13)]
                part = terms[first[lo] : first[lo + len(n)]]
                begins = first[lo : lo + len(n)] - first[lo]
                norm = np.maximum(np.sqrt(np.add.reduceat(squares[part], begins)), 1e-9)
                y = _summed(part, begins, n, projection) / (norm[:, None] ** 2).astype(np.float32)
                order = np.argsort(part.astype(kind), kind="stable")
                ordered = part[order]
                each = np.flatnonzero(np.append(True, np.diff(ordered) != 0))
                out[ordered[each]] += np.add.reduceat(y[np.repeat(np.arange(len(n)), n)[order]], each, axis=0)
        out = out * idf[:, None]
        pieces = [out[a : a + block].tobytes() for a in range(0, settings.terms, block)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.binary())], names=["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, sums in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist()):
                total[b] = total.get(b, 0.0) + np.frombuffer(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["block", "sums"]
        )

    schema = "block int, sums binary"
    rows = sample.mapInArrow(multiply, schema).repartition(F.col("block")).mapInArrow(add, schema).collect()
    whole = b"".join(bytes(r.sums) for r in sorted(rows, key=lambda r: r.block))  # the size of the basis
    return np.frombuffer(whole).reshape(settings.terms, width) if whole else np.zeros((settings.terms, width))


@dataclass(frozen=True)
class Index:
    """Projection of each term, its inverse document frequency included."""

    projection: np.ndarray
    idf: np.ndarray
    settings: Settings


def fit(docs: DataFrame, settings: Settings = Settings()) -> Index:
    """Document frequencies of all passages, and a randomised SVD with power iterations."""
    seen, passages = _document_frequencies(docs, settings)
    idf = np.log((passages + 1) / (seen + 1))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    share = min(1.0, settings.fit_bytes / max(size, 1))
    chosen = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("text")

    def passages_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            terms, counts = _terms_of(batch.column("text"), settings)
            yield pa.RecordBatch.from_arrays(
                [pa.array([terms.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())], names=["terms", "counts"]
            )

    sample = pin(chosen.mapInArrow(passages_of, "terms binary, counts binary"), "passages")
    basis = np.random.default_rng(settings.seed).standard_normal((settings.terms, settings.rank + settings.oversample))
    for _ in range(settings.iterations):
        basis = np.linalg.qr(_applied(sample, idf, basis, settings))[0]
    squares, turn = np.linalg.eigh(basis.T @ _applied(sample, idf, basis, settings))
    leading = basis @ turn[:, np.argsort(-squares)[: settings.rank]]
    return Index(_weighted(idf, leading), idf, settings)


@dataclass(frozen=True)
class Rare:
    """Rare words of the short items: ``item`` and ``at`` from ``first[k]`` to ``first[k + 1]`` are the places of ``keys[k]``."""

    keys: np.ndarray
    first: np.ndarray
    item: np.ndarray
    at: np.ndarray
    #: Per item, how many of its rare words a leak holds at least, and in how many words.
    least: np.ndarray
    within: np.ndarray
    #: Whether a word whose hash has these upper bits can be one of the keys.
    maybe: np.ndarray


def _slack(length: int) -> int:
    """Words looked at before and after the place of an item."""
    return 8 + length // 4


def _short_slack(length: int) -> int:
    """The same for short items, few words of which would be in order in any longer run."""
    return length // 4


def _rare(lists: list[np.ndarray], index: Index) -> Rare:
    settings = index.settings
    least, within, keys, item, at = [], [], [], [], []
    for i, own in enumerate(lists):
        n = len(own)
        needed = next((c for c in range(1, n + 1) if c / n >= min(settings.partial, settings.whole)), n)
        least.append(min(settings.rare, needed))
        within.append(n + 2 * _short_slack(n))
        if n >= settings.words:
            continue
        rarest = np.argsort(-index.idf[own % np.uint64(settings.terms)], kind="stable")[: n - needed + least[-1]]
        # All places of a word at once, so that each is an anchor.
        places = np.flatnonzero(np.isin(own, own[rarest]))
        keys.append(own[places])
        at.append(places)
        item.append(np.full(len(places), i))
    none = [np.empty(0, np.int64)]
    words, places, owners = np.concatenate([np.empty(0, np.uint64), *keys]), np.concatenate(none + at), np.concatenate(none + item)
    order = np.argsort(words, kind="stable")
    unique, first = np.unique(words[order], return_index=True)
    maybe = np.zeros(1 << 20, dtype=bool)
    maybe[unique >> np.uint64(44)] = True
    return Rare(unique, np.append(first, len(words)), owners[order], places[order], np.array(least), np.array(within), maybe)


@dataclass(frozen=True)
class Items:
    """Benchmark items of one pass: words, where answers begin, and passages to search with."""

    ids: list
    words: list[np.ndarray]
    answers: list[int]
    #: Per passage its item, its first word in the item, its words, a bit for each, and its vector.
    item: np.ndarray
    start: np.ndarray
    rows: np.ndarray
    bits: np.ndarray
    vectors: np.ndarray
    #: Whether a word whose hash has these upper bits can be in a passage.
    maybe: np.ndarray
    rare: Rare


def _items(rows: list, index: Index) -> Items:
    """An item's passages follow one another; the last one ends with the item."""
    settings = index.settings
    words, hashes, stops = _normal(pa.array([r.text for r in rows], pa.string()))
    terms, narrow = (hashes % np.uint64(settings.terms)).astype(np.int32), _narrow(hashes)
    lists, answers, item, begins = [], [], [], []
    for i, (lo, hi) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
        own = hashes[lo:hi]
        ends = np.flatnonzero(stops[lo:hi][:-1])
        lists.append(own)
        answers.append(int(ends[-1]) + 1 if len(ends) else 0)
        if len(own) >= settings.words:
            last = len(own) - settings.words
            for start in [*range(0, last, settings.words), last]:
                item.append(i)
                begins.append(lo + start)
    at = np.array(begins, dtype=np.int64)[:, None] + np.arange(settings.words)
    item = np.array(item, dtype=np.int64)
    wide = narrow[at] if len(at) else np.empty((0, settings.words), np.int32)
    chosen = terms[at] if len(at) else np.empty((0, settings.words), np.int32)
    maybe = np.zeros(1 << 20, dtype=bool)
    maybe[hashes[at.ravel()] >> np.uint64(44)] = True
    return Items(
        [r.item_id for r in rows], lists, answers, item, at[:, 0] - words.first[item] if len(at) else item, wide, _bits(wide),
        _unit(_embedded(chosen, index.projection)), maybe, _rare(lists, index),
    )


def _narrow(hashes: np.ndarray) -> np.ndarray:
    """31 bits of each hash, never zero."""
    return (hashes >> np.uint64(33)).astype(np.int32) | 1


def _bits(rows: np.ndarray) -> np.ndarray:
    """A bit of 64 for each word of a row."""
    bits = np.left_shift(np.uint64(1), (rows >> 1 & 63).astype(np.uint64))
    return np.bitwise_or.reduce(np.where(rows != 0, bits, np.uint64(0)), axis=1)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each row of ``a`` with that of ``b``; zeros match nothing."""
    n, length = a.shape
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(np.where(b == 0, -1, b).T)
    above = np.zeros((length + 1, n), dtype=np.int8)
    for i in range(length):
        row = np.zeros((length + 1, n), dtype=np.int8)
        for j in range(length):
            row[j + 1] = np.maximum(np.maximum(row[j], above[j + 1]), above[j] + (a[i] == b[j]))
        above = row
    return above[length]


def subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a row of the table as the bits of one number."""
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    state = full = (1 << len(a)) - 1
    for x in b.tolist():
        hit = state & places.get(x, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def _checked(item: np.ndarray, answer: int, region: np.ndarray, settings: Settings) -> tuple[float, bool, bool]:
    """Share of the item in the region, whether its answer is there, whether that is a leak."""
    share = subsequence(item, region) / len(item)
    said = item[answer:]
    there = bool(len(said)) and subsequence(said, region) >= settings.answer * len(said)
    return share, there, share >= settings.whole or (share >= settings.partial and there)


def _anchors(hashes: np.ndarray, words: Words, rare: Rare, settings: Settings) -> Iterator[tuple[int, int, int]]:
    """Item, document and where the item would begin, for places with enough of its rare words."""
    at = np.flatnonzero(rare.maybe[hashes >> np.uint64(44)])
    slot = np.minimum(np.searchsorted(rare.keys, hashes[at]), max(len(rare.keys) - 1, 0))
    if not len(at):
        return
    same = rare.keys[slot] == hashes[at]
    at, slot = at[same], slot[same]
    doc = np.searchsorted(words.first, at, side="right") - 1
    counts = rare.first[slot + 1] - rare.first[slot]
    # By whole documents, since a place never reaches from one into the next.
    ends = np.flatnonzero(np.append(np.diff(doc) != 0, True)) + 1 if len(doc) else []
    lo, done, total = 0, 0, np.cumsum(counts)
    for hi, after in zip(ends, [*ends[1:], None]):
        if after is not None and total[after - 1] - done <= settings.places:
            continue
        part, done = slice(lo, hi), total[hi - 1]
        lo, n = hi, counts[part]
        posting = np.repeat(rare.first[slot[part]], n) + positions(n)
        item, place, of = rare.item[posting], np.repeat(at[part], n), np.repeat(doc[part], n)
        order = np.lexsort((place, item))
        posting, item, place, of = posting[order], item[order], place[order], of[order]
        begin = np.arange(len(item))
        end = begin + rare.least[item] - 1
        inside = np.minimum(end, len(item) - 1)
        near = (end < len(item)) & (item[inside] == item) & (of[inside] == of) & (place[inside] - place < rare.within[item])
        edges = np.zeros(len(item) + 1, dtype=np.int64)
        np.add.at(edges, begin[near], 1)
        np.add.at(edges, end[near] + 1, -1)
        hit = np.cumsum(edges[:-1]) > 0
        found = np.stack([item[hit], of[hit], place[hit] - rare.at[posting[hit]]], axis=1)
        yield from map(tuple, np.unique(found, axis=0).tolist())


def _runs(values: np.ndarray, length: int, add: np.ufunc) -> np.ndarray:
    """``add`` over each run of ``length`` values, by runs of powers of two."""
    out, done, power, size = None, 0, values, 1
    while True:
        if length & size:
            part = power[done : len(values) - length + 1 + done]
            out = part if out is None else add(out, part)
            done += size
        if done == length:
            return out
        power, size = add(power[:-size], power[size:]), 2 * size


@dataclass(frozen=True)
class _Near:
    """Passages of a batch close to one of an item: first word, document, passage of the item, cosine."""

    at: np.ndarray
    doc: np.ndarray
    passage: np.ndarray
    cosine: np.ndarray


def _near(words: Words, hashes: np.ndarray, index: Index, items: Items) -> Iterator[_Near]:
    """Candidates whose words are in order as in the item's passage, ``shared`` of them at least."""
    settings, length = index.settings, index.settings.words
    if not len(items.item):
        return
    shared = np.full(len(items.item), settings.shared)
    # As many of 64 bits are common as words must be, less those that the item's passage says twice.
    bits = shared - (length - np.bitwise_count(items.bits).astype(np.int64))
    terms, narrow = (hashes % np.uint64(settings.terms)).astype(np.int32), _narrow(hashes)
    known = items.maybe[hashes >> np.uint64(44)]

    def chosen(rows: np.ndarray, vectors: np.ndarray, own: np.ndarray, at: np.ndarray, doc: np.ndarray) -> Iterator[_Near]:
        cosine = _unit(vectors) @ items.vectors.T
        p, q = np.divmod(np.flatnonzero(cosine >= settings.cosine), len(items.item))
        alike = np.bitwise_count(own[p] & items.bits[q]) >= bits[q]
        p, q = p[alike], q[alike]
        if len(p):
            close = _common(rows[p], items.rows[q]) >= shared[q]
            p, q = p[close], q[close]
            yield _Near(at[p], doc[p], q, cosine[p, q])

    counts = np.concatenate([[0], np.cumsum(known)])
    starts = np.arange(max(len(hashes) - length + 1, 0))
    of = np.repeat(np.arange(len(words.counts)), words.counts)
    full = np.zeros(len(starts), dtype=bool)
    if len(starts):
        doc = of[starts]
        end = words.first[doc + 1] - starts - length
        placed = (end == 0) | ((end > 0) & ((starts - words.first[doc]) % settings.step == 0))
        full = placed & (counts[starts + length] - counts[starts] >= settings.shared)
    marks = np.left_shift(np.uint64(1), (narrow >> 1 & 63).astype(np.uint64))
    for lo in range(0, len(starts), settings.slab):
        wanted = np.flatnonzero(full[lo : lo + settings.slab])
        if len(wanted):
            hi = min(lo + settings.slab + length - 1, len(hashes))
            vectors = _runs(index.projection[terms[lo:hi]], length, np.add)[wanted]
            own = _runs(marks[lo:hi], length, np.bitwise_or)[wanted]
            at = wanted + lo
            yield from chosen(sliding_window_view(narrow, length)[at], vectors, own, at, of[at])
    # A text shorter than a passage is one, if it can hold enough of an item.
    short = np.flatnonzero((words.counts >= settings.shared) & (words.counts < length))
    for lo in range(0, len(short), settings.slab):
        doc = short[lo : lo + settings.slab]
        at = words.first[doc]
        index_of = at[:, None] + np.arange(length)
        inside = index_of < words.first[doc + 1][:, None]
        index_of = np.minimum(index_of, len(hashes) - 1)
        rows = np.where(inside, narrow[index_of], 0)
        vectors = _embedded(np.where(inside, terms[index_of], settings.terms), index.projection)
        yield from chosen(rows, vectors, _bits(rows), at, doc)


def _found(batch: pa.RecordBatch, index: Index, items: Items) -> dict[tuple[int, int], tuple[float, bool, float | None]]:
    """Share, answer and cosine of each leak, by row of the batch and item; short items have no cosine."""
    settings = index.settings
    words, hashes, _ = _normal(batch.column("text"))
    best: dict[tuple[int, int], tuple[float, bool, float | None]] = {}
    known: dict[tuple[int, int, int], tuple[float, bool, bool]] = {}

    def checked(item: int, d: int, start: int, slack: int) -> tuple[float, bool, bool]:
        lo, hi = max(int(words.first[d]), start - slack), min(int(words.first[d + 1]), start + len(items.words[item]) + slack)
        if (item, lo, hi) not in known:
            known[item, lo, hi] = _checked(items.words[item], items.answers[item], hashes[lo:hi], settings)
        return known[item, lo, hi]

    for near in _near(words, hashes, index, items):
        for at, d, passage, cosine in zip(near.at.tolist(), near.doc.tolist(), near.passage.tolist(), near.cosine.tolist()):
            item = int(items.item[passage])
            share, there, leak = checked(item, d, at - int(items.start[passage]), _slack(len(items.words[item])))
            if leak:
                found = (share, there, cosine)
                best[d, item] = max(best.get((d, item), found), found)
    for item, d, start in _anchors(hashes, words, items.rare, settings):
        share, there, leak = checked(item, d, start, _short_slack(len(items.words[item])))
        if leak and ((d, item) not in best or (share, there) > best[d, item][:2]):
            best[d, item] = (share, there, None)
    return best


SCHEMA = "doc_id bigint, item_id bigint, cosine double, lcs double, answer boolean"


def _search(docs: DataFrame, index: Index, items: Items) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, rows=1024):
            best = _found(batch, index, items)
            ids = batch.column("doc_id").cast(pa.int64()).take(pa.array([d for d, _ in best], pa.int64()))
            shares, answers, cosines = zip(*best.values()) if best else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array([items.ids[i] for _, i in best], pa.int64()), pa.array(cosines, pa.float64()),
                    pa.array(shares, pa.float64()), pa.array(answers, pa.bool_()),
                ],
                names=["doc_id", "item_id", "cosine", "lcs", "answer"],
            )

    return docs.select("doc_id", "text").mapInArrow(find, SCHEMA)


def _blocks(benchmark: DataFrame, settings: Settings) -> Iterator[list]:
    """Items with a text, by about ``items`` at a time: the query, which comes to the driver."""
    benchmark = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null")
    blocks = -(-benchmark.count() // settings.items)
    for b in range(blocks):
        yield benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()


def without_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns; nothing is joined.

    Whatever ``leaks`` reports goes, rows without an id too.
    """
    index, schema = None, docs.schema
    for rows in _blocks(benchmark, settings):
        index = index or fit(docs, settings)
        items = _items(rows, index)

        def sift(batches: Iterator[pa.RecordBatch], index: Index = index, items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in small(batches, rows=1024):
                stay = np.ones(batch.num_rows, dtype=bool)
                stay[[d for d, _ in _found(batch, index, items)]] = False
                yield batch.filter(pa.array(stay))

        docs = docs.mapInArrow(sift, schema)
    return docs


def leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, item_id, cosine, lcs, answer`` for each document and benchmark item it holds.

    ``lcs`` is the share of the item's words, in lower case and without a trailing mark, that
    the document holds in order around the place found. A document leaks an item if that is
    ``whole`` or more, or ``partial`` or more and the item's answer (its last sentence) is
    there too. ``cosine`` is that of the closest passages, null for items shorter than a
    passage, which are looked up by their words. Needs ``doc_id`` and ``text`` of documents, ``item_id`` and ``text`` of items;
    other columns are not read. Texts that are null or have no words hold nothing, and
    such items are in nothing. Documents without an id are reported with a null id, repeated
    rows once. An empty table on either side gives no rows.

    The items are the query: they come to the driver by at most ``items`` at a time, and
    each such block is one pass over all documents.
    """
    index, out = None, None
    for rows in _blocks(benchmark, settings):
        index = index or fit(docs, settings)
        found = _search(docs, index, _items(rows, index))
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    return out.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("lcs").alias("lcs"), F.max("answer").alias("answer"))
