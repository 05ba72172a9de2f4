"""Near duplicates by SimHash, found by balls that meet in the middle.

Two fingerprints that differ in ``2h`` bits have a word halfway, at ``h`` bits from both.
So each fingerprint emits every variant within ``h`` bits, and whatever shares a variant is
compared. For an odd distance ``2h + 1`` one bit remains: the fingerprint is cut into a few
parts, and each part in turn is left out. A pair that differs anywhere differs in some
part; without that part at most ``2h`` bits differ, and the balls over the rest meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.llm.components import components
from rollcall.llm.tables import dealt
from rollcall.llm.words import small
from rollcall.session import pin

BITS = 64
SEED = 42
#: Shingles whose bits are counted at a time.
SLAB = 1 << 15


def _bits_set(digests: list[int]) -> np.ndarray:
    raw = np.array(digests, dtype=np.uint64).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Majority of the bits of all shingle hashes, as a signed 64-bit number."""
    words = text.lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = min(shingle, len(words)) - 1
    total = len(words) - last
    counts = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, total, SLAB):
        hi = min(lo + SLAB, total)
        spans = zip(starts[lo:hi].tolist(), ends[lo + last : hi + last].tolist())
        counts += _bits_set([digest(joined[a:b], SEED) for a, b in spans])
    value = np.packbits(2 * counts > total, bitorder="little").view(np.int64)
    return int(value[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, text_hash, fp)`` of each row. A null text, or one without words, has fingerprint zero."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = batch.column("text").fill_null("").cast(pa.binary())
            found = [fingerprint(t.as_py(), shingle) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(found, pa.int64())], names=["doc_id", "text_hash", "fp"]
            )

    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return keyed.mapInArrow(of, "doc_id bigint, text_hash bigint, fp bigint")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _parts(distance: int, parts: int) -> list[int]:
    """Masks of the parts left out in turn; for an even distance nothing is left out."""
    if distance % 2 == 0:
        return [0]
    cuts = [BITS * k // parts for k in range(parts + 1)]
    return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]


def variants(distance: int, parts: int) -> list[tuple[int, int, int]]:
    """``(part, bits kept, bits flipped)`` of every variant a fingerprint emits."""
    out = []
    for part, mask in enumerate(_parts(distance, parts)):
        keep = [b for b in range(BITS) if not mask >> b & 1]
        for size in range(distance // 2 + 1):
            for bits in combinations(keep, size):
                out.append((part, _signed(~mask & ((1 << 64) - 1)), _signed(sum(1 << b for b in bits))))
    return out


def links(fps: DataFrame, distance: int = 3, parts: int = 3) -> DataFrame:
    """Pairs ``(a, b)``, ``a < b``, of distinct fingerprints at most ``distance`` bits apart.

    ``fps`` has one row per distinct fingerprint in ``fp``, so copies never meet each
    other. At distance 3 with three parts each emits 132 rows of one part number and two
    longs. Members of a bucket agree in 42 bits but for two; how many distinct
    fingerprints that can be depends on the bits, not on the number of documents. With
    ``n`` fingerprints about ``3e-10 * n`` chance members meet in the buckets of each. The
    pair is checked inside the join and kept in one of the buckets it shares, so every
    link leaves it about once. More parts mean more rows and fewer chance members.
    """
    each = F.array(*[F.struct(F.lit(p).alias("part"), F.lit(k).alias("keep"), F.lit(f).alias("flip")) for p, k, f in variants(distance, parts)])
    emitted = dealt(fps, "fp").select("fp", F.explode(each).alias("x")).select(
        F.col("x.part").alias("part"),
        F.col("fp").bitwiseAND(F.col("x.keep")).bitwiseXOR(F.col("x.flip")).alias("variant"),
        "fp",
    )
    shared = pin(
        emitted.withColumn("n", F.count("*").over(W.partitionBy("part", "variant"))).where("n > 1").drop("n"), "variants"
    )
    a, b = shared.alias("a"), shared.alias("b")
    differing = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    return (
        a.join(
            b,
            (F.col("a.part") == F.col("b.part")) & (F.col("a.variant") == F.col("b.variant"))
            & (F.col("a.fp") < F.col("b.fp")) & (F.bit_count(differing) <= distance),
        )
        .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
        .distinct()
    )


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, parts: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs``.

    Needs ``doc_id`` and ``text``; other columns are not read. Texts without words have
    fingerprint zero and link like any other. ``component_id`` is the least id in the
    component; rows with a null id take part, and it is null if all ids are. Repeated
    rows stay. An empty table gives no rows.
    """
    known, of_fp = _components(docs, shingle, distance, parts)
    return known.join(of_fp, "fp").select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def _components(docs: DataFrame, shingle: int, distance: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of each row, and root and least id of each fingerprint's component."""
    known = pin(fingerprints(docs, shingle), "fingerprints")
    distinct = known.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = components(links(distinct.select("fp"), distance, parts), "fingerprints")
    found = distinct.join(rooted, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = found.groupBy("root").agg(F.min("least").alias("component_id"))
    return known, found.select("fp", "root").join(ids, "root")


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 3, parts: int = 3) -> DataFrame:
    """One row of ``docs`` per component, with all its columns: that of least id.

    Rows without an id come last; among equal ids the text of least hash stays, and of
    repeated rows any one.
    """
    known, of_fp = _components(docs, shingle, distance, parts)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    kept = known.join(of_fp, "fp").groupBy("root").agg(first).select(
        F.col("first.doc_id").alias("__id"), F.col("first.text_hash").alias("__hash")
    )
    keyed = docs.withColumn("__text_hash", F.xxhash64("text"))
    same = keyed["__text_hash"].eqNullSafe(kept["__hash"]) & keyed["doc_id"].eqNullSafe(kept["__id"])
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", "__text_hash"]).drop("__text_hash")


def hexadecimal(value: Column) -> Column:
    """Sixteen lower-case hex digits of a long."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
