"""Repeated passages removed, by level-wise doubling.

A passage that occurs twice consists of shorter passages that occur twice. So windows are
judged at a short length first, and only where one is repeated the windows of twice the
length are looked at.

Not every short window has to be sent around. In each full window the short one with the
smallest hash stands for it; equal full windows hold the same short windows, so the same
one stands for all of them, wherever they are. For lengths 10 and 20 one word in six
starts such a short window, and it stands for six full ones on average.

The full windows that one short window stands for are neighbours and make up a span. Equal
spans hold equal windows: where a span occurs again, all its windows do, and only its first
occurrence goes on. Single full windows are compared only for short windows found in
different spans, that is at the edges of what is repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.llm.words import Words, covered, mix, positions, repeats_in_groups, rolling, small, sums, windows, words_of
from rollcall.session import pin

#: Second seed, for the wider hash of spans and full windows.
_OTHER = np.uint64(0xD6E8FEB86659FD93)

#: Places in a packed span: first word above, then 16 bits of the text's checksum, whether the
#: document holds the span before, and the number of windows (``length / 2 + 1`` at most) in 15 bits.
_AT, _CHECK, _LATER, _SIZE = 32, 16, 1 << 15, (1 << 15) - 1
#: Texts without an id come after all others; among themselves none is earlier.
_LAST = (1 << 63) - 1


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts with a key of their own: a hash of id and text, and a checksum of the text.

    Together 80 bits, so that verdicts never meet another text that shares the id.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.xxhash64(text, "doc_id").alias("rid"),
        F.crc32(text).bitwiseAND(0xFFFF).alias("checksum"),
        F.coalesce(F.col("doc_id"), F.lit(_LAST)).alias("ord"),
        "doc_id",
        text.alias("text"),
    )


def _standing(hashes: np.ndarray, at: np.ndarray, short: int, length: int) -> np.ndarray:
    """Per full window from ``at``: the start of the short window that stands for it."""
    if not len(at):
        return at
    starts = np.arange(len(hashes) - short + 1)
    grams = rolling(hashes, starts, starts + short)
    view = sliding_window_view(grams, length - short + 1)
    out = np.empty(len(at), dtype=np.int64)
    for lo in range(0, len(at), 1 << 17):
        part = at[lo : lo + (1 << 17)]
        out[lo : lo + len(part)] = part + np.argmin(view[part], axis=1)
    return out


def _wide(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes ^ _OTHER)


def _upper(hashes: np.ndarray) -> np.ndarray:
    """32 bits of each hash as a signed number."""
    return (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _shorts(batch: pa.RecordBatch, short: int, length: int) -> tuple[np.ndarray, ...]:
    """Per short window that stands for others: its hash, that of its span, document, first full window, their number."""
    words = words_of(batch.column("text"))
    hashes = words.hashes()
    at, doc = windows(words, length)
    if not len(at):
        none = np.empty(0, dtype=np.int64)
        return none, none.astype(np.int32), none, none, none
    stands = _standing(hashes, at, short, length)
    begins = np.flatnonzero(np.append(True, (np.diff(stands) != 0) | (np.diff(doc) != 0)))
    sizes = np.diff(np.append(begins, len(at)))
    of, first = doc[begins], at[begins]
    h = rolling(hashes, stands[begins], stands[begins] + short).view(np.int64)
    g = _upper(rolling(_wide(hashes), first, first + sizes + length - 1))
    return h, g, of, first - words.first[of], sizes


def _counted(docs: DataFrame, short: int, length: int) -> DataFrame:
    """``(h, g, c, first)``: how often a short window occurs in a span, and the least document of it.

    Equal ones are put together within each batch, so that a passage in a third of all
    documents leaves one row per batch.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, rows=2048, size=8 << 20):
            h, g, doc, _, _ = _shorts(batch, short, length)
            ids = batch.column("ord").to_numpy()[doc]
            order = np.lexsort((ids, g, h))
            h, g, ids = h[order], g[order], ids[order]
            begins = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1]))) if len(h) else order
            counts = np.diff(np.append(begins, len(h)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (h[begins], g[begins], counts, ids[begins])], names=["h", "g", "c", "first"]
            )

    return docs.select("ord", "text").mapInArrow(emit, "h bigint, g int, c bigint, first bigint")


def _placed(docs: DataFrame, short: int, length: int) -> DataFrame:
    """``(h, g, rid, ord, span)`` for each place of a short window that stands for others."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, rows=1024):
            h, g, doc, lo, n = _shorts(batch, short, length)
            _, later = repeats_in_groups(mix(h.view(np.uint64)) ^ g.view(np.uint32).astype(np.uint64), doc)
            check = batch.column("checksum").to_numpy()[doc]
            span = lo << _AT | check << _CHECK | later * _LATER | n
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(g), *[batch.column(c).take(pa.array(doc)) for c in ("rid", "ord")], pa.array(span)],
                names=["h", "g", "rid", "ord", "span"],
            )

    return docs.select("rid", "ord", "checksum", "text").mapInArrow(emit, "h bigint, g int, rid bigint, ord bigint, span bigint")


def _span_verdicts(docs: DataFrame, short: int, length: int) -> DataFrame:
    """``(rid, checksum, spans)``: per text what occurs earlier, as negative numbers, and what is still open.

    The first shuffle finds short windows that occur twice, the second one fetches their
    places; a join splits a short window that very many documents hold.
    """
    found = _counted(docs, short, length).repartition(F.col("h"))
    found = found.groupBy("h", "g").agg(F.sum("c").alias("c"), F.min("first").alias("first"))
    same = W.partitionBy("h")
    repeated = (
        found.withColumn("total", F.sum("c").over(same)).withColumn("kinds", F.count("*").over(same))
        .where("total > 1").select("h", "g", "first", (F.col("kinds") > 1).alias("open"))
    )
    gone = (F.col("ord") > F.col("first")) | (F.col("span").bitwiseAND(_LATER) != 0)
    return (
        _placed(docs, short, length).join(repeated, ["h", "g"])
        .withColumn("gone", gone).where("gone or open")
        .groupBy("rid", F.shiftright("span", _CHECK).bitwiseAND(0xFFFF).alias("checksum"))
        .agg(F.collect_set(F.when(F.col("gone"), -F.col("span")).otherwise(F.col("span"))).alias("spans"))
    )


def _windows_in(lists: pa.Array, words: Words, length: int, gone: bool) -> tuple[np.ndarray, np.ndarray]:
    """Full windows, and their documents, in the spans that are gone or in those still open."""
    spans, sizes = lists.flatten().to_numpy(), lists.value_lengths().fill_null(0).to_numpy()
    doc = np.repeat(np.arange(len(lists)), sizes)
    wanted = (spans < 0) == gone
    spans, doc = np.abs(spans[wanted]), doc[wanted]
    n = spans & _SIZE
    at = np.unique(np.repeat(words.first[doc] + (spans >> _AT), n) + positions(n))
    doc = np.searchsorted(words.first, at, side="right") - 1
    inside = at + length <= words.first[doc + 1]
    return at[inside], doc[inside]


def _open_windows(texts: DataFrame, length: int) -> DataFrame:
    """``(h, g, rid, checksum, ord, lo, later)``: full windows of open spans, with a 96-bit hash."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, rows=1024):
            words = words_of(batch.column("text"))
            hashes = words.hashes()
            at, doc = _windows_in(batch.column("spans"), words, length, gone=False)
            h = rolling(hashes, at, at + length)
            _, later = repeats_in_groups(h, doc)
            taken = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h.view(np.int64)), pa.array(_upper(rolling(_wide(hashes), at, at + length))),
                    *[batch.column(c).take(taken) for c in ("rid", "checksum", "ord")],
                    pa.array(at - words.first[doc]), pa.array(later),
                ],
                names=["h", "g", "rid", "checksum", "ord", "lo", "later"],
            )

    return texts.where(F.exists("spans", lambda s: s > 0)).select("rid", "checksum", "ord", "text", "spans").mapInArrow(
        emit, "h bigint, g int, rid bigint, checksum bigint, ord bigint, lo bigint, later boolean"
    )


def _window_verdicts(texts: DataFrame, length: int) -> DataFrame:
    """``(rid, checksum, starts)``: single full windows that occur earlier."""
    single = pin(_open_windows(texts, length), "windows")
    firsts = single.groupBy("h", "g").agg(F.min("ord").alias("first"))
    return (
        single.join(firsts, ["h", "g"]).where("later or ord > first")
        .groupBy("rid", "checksum").agg(F.collect_set(-(F.shiftleft("lo", _AT) + 1)).alias("singles"))
    )


def _kept(texts: DataFrame, length: int, with_text: bool) -> DataFrame:
    """What is left of each text."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, rows=1024):
            words = words_of(batch.column("text"))
            total = len(words.starts)
            gone = np.zeros(total, dtype=bool)
            for name in ("spans", "singles"):
                gone |= covered(_windows_in(batch.column(name), words, length, gone=True)[0], length, total)
            data, digests, kept = words.data.tobytes(), [], []
            starts, ends = words.starts.tolist(), words.ends.tolist()
            for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
                left = (np.flatnonzero(~gone[lo:hi]) + lo).tolist()
                text = b" ".join([data[starts[i] : ends[i]] for i in left])
                digests.append(hashlib.sha256(text).hexdigest())
                kept.append(text.decode() if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), pa.array(words.counts.astype(np.int64)),
                    pa.array(sums(gone, words.first)),
                    pa.array(digests, pa.string()), pa.array(kept, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    found = texts.select("doc_id", "text", "spans", "singles").mapInArrow(
        emit, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"
    )
    return found if with_text else found.drop("kept")


def remove_repeats(docs: DataFrame, length: int = 20, with_text: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and ``kept``, the words left joined by one space.

    A word goes if some window of ``length`` (even, up to 65,532) words over it also starts earlier: in a
    document of smaller id, or before in the same one. Windows are judged on the texts as
    they come. Needs ``doc_id`` and ``text``; other columns are not read. A null text has
    no words, a text shorter than a window loses none. Texts without an id come after all
    others, and none of them counts as earlier for another; the same holds for rows that
    share an id, whose texts may differ. Repeated rows get equal results.

    Texts are shuffled once, to meet their verdicts.
    """
    if length < 2 or length % 2 or length // 2 + 1 > _SIZE:
        raise ValueError(f"length must be even, from 2 to {2 * _SIZE - 2}: {length}")
    texts = _keyed(docs)
    spans = _span_verdicts(texts, length // 2, length)
    texts = texts.join(pin(spans, "spans"), ["rid", "checksum"], "left")
    return _kept(texts.join(_window_verdicts(texts, length), ["rid", "checksum"], "left"), length, with_text)
