"""Sources mixed to target weights, in blocks of words.

The texts of a source are laid end to end and cut into blocks of a fixed number of words.
Each source has as many slots in the mixture as its target asks for blocks. A slot falls
into an output shard by a hash, so the counts of the sources in a shard are a multinomial
draw, with totals that keep to the targets. A pseudorandom permutation of the source's block
numbers says which block fills which slot; where there are more slots than blocks the
numbers start anew with another permutation, so no block comes up twice before all others
did. Slots and blocks are joined by block number.

Everything is DataFrame expressions. A source of any share is packed in parts of a bounded
number of rows, and from there on keys are single blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.llm.tables import dealt
from rollcall.llm.words import WORD
from rollcall.session import pin

WEIGHTS = (1, 2, 3)
ROUNDS = 24


@dataclass(frozen=True)
class Settings:
    """Parameters of a mixture."""

    #: Weights of the sources in order of their names, repeated as often as needed.
    weights: tuple[int, ...] = WEIGHTS
    #: No source, and no block of it, comes up more often.
    most: int = 3
    block_words: int = 64
    shards: int = 64
    #: Rows of a source that are laid end to end in one task.
    rows_per_part: int = 5_000
    seed: int = 42


def words_in(text: Column) -> Column:
    """Number of words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``sid, source, source_size, rows, target`` for each source of ``sizes (source, size)``.

    Names go by code point, null last. All sizes are shared out by weight; a target stops at
    ``most`` times its source's size and the excess goes to the others by weight, until none
    is above. That is one level ``v`` with targets ``min(weight * v, cap)``: with sources in
    order of ``cap / weight`` those before some place are capped, and the first place whose
    level its own cap bears gives ``v``. The windows run over sources, not rows.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    weight = F.get(F.array(*map(F.lit, settings.weights)), (F.col("sid") % len(settings.weights)).cast("int"))
    ranked = (
        totals.withColumn("sid", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", weight).withColumn("cap", settings.most * F.col("source_size"))
        .withColumn("bears", F.col("cap") / F.col("weight"))
    )
    order = W.orderBy("bears", "sid")
    every = W.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(
        F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    level = left / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    found = ranked.withColumn("level", level)
    fill = F.max(F.when(F.col("level") <= F.col("bears"), F.col("level"))).over(every)
    target = F.least(F.col("weight") * fill, F.col("cap").cast("double"))
    return found.select("sid", "source", "source_size", "rows", F.coalesce(target, F.lit(0.0)).alias("target"))


def permuted(x: Column, n: Column, seed: int, *tweak: Column) -> Column:
    """A pseudorandom permutation of ``0 .. n - 1``, another for each tweak.

    The swap-or-not shuffle: a round pairs each number with its mirror image around a
    secret place and swaps them or not, as a bit of a hash of the larger one says.
    """

    def turn(at: Column, r: Column) -> Column:
        mirrored = F.pmod(F.xxhash64(F.lit(seed), *tweak, r) - at, n)
        swap = F.xxhash64(F.lit(seed + 1), *tweak, r, F.greatest(at, mirrored)).bitwiseAND(1) == 1
        return F.when(swap, mirrored).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("bigint"), turn)


@dataclass(frozen=True)
class Mixture:
    """``rows``: each input row with its place; ``pieces``: which of its words lie in which block;
    ``slots``: which block is drawn, in which turn, for which shard and where in it."""

    rows: DataFrame
    pieces: DataFrame
    slots: DataFrame


def mix(sizes: DataFrame, settings: Settings = Settings(), ties: Sequence[str] = ()) -> Mixture:
    """The mixture of ``sizes (doc_id, source, size)``.

    Each row comes back, repeated ones too, with ``sid, part, at`` (its place),
    ``source_size`` and ``target``; further columns, whatever their names, in the struct
    ``more``. ``ties`` names those of them that tell rows of equal id and size apart. A null
    source is a source of its own, a null size none.
    """
    more = [F.col(c) for c in sizes.columns if c not in ("doc_id", "source", "size")]
    sized = pin(
        sizes.select(
            "doc_id", "source", F.coalesce("size", F.lit(0)).cast("bigint").alias("size"),
            (F.struct(*more) if more else F.lit(None).cast("string")).alias("more"),
        ),
        "sizes",
    )
    width = settings.block_words
    sources = pin(source_targets(sized, settings), "sources")
    parts = F.ceil(F.col("rows") / settings.rows_per_part)
    known = sources.withColumnRenamed("source", "name")
    placed = (
        sized.join(known, F.col("source").eqNullSafe(F.col("name"))).drop("name")
        .withColumn("part", F.pmod(F.xxhash64(F.lit(settings.seed), "doc_id", "size"), parts))
    )
    in_order = W.partitionBy("sid", "part").orderBy("doc_id", "size", *[F.col("more")[t] for t in ties]).rowsBetween(W.unboundedPreceding, -1)
    rows = pin(placed.withColumn("at", F.coalesce(F.sum("size").over(in_order), F.lit(0))).drop("rows"), "rows")

    cut = rows.groupBy("sid", "part").agg(F.sum("size").alias("words"))
    cut = cut.withColumn("blocks", F.ceil(F.col("words") / width))
    before = W.partitionBy("sid").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    cut = cut.withColumn("offset", F.coalesce(F.sum("blocks").over(before), F.lit(0)))
    cut = cut.withColumn("n", F.sum("blocks").over(W.partitionBy("sid")))
    cut = pin(cut.join(sources.select("sid", "source_size", "target"), "sid").where("blocks > 0"), "parts")

    x, n, sid, turn = F.col("x"), F.col("n"), F.col("sid"), F.col("turn")
    wanted = F.least(F.round(F.col("target") / F.col("source_size") * n), settings.most * n)
    slot = x + turn * n
    slots = (
        dealt(cut, "sid", "part").withColumn("wanted", wanted)
        .withColumn("x", F.explode(F.sequence(F.col("offset"), F.col("offset") + F.col("blocks") - 1)))
        .withColumn("turn", F.explode(F.array(*map(F.lit, range(settings.most)))))
        .where(slot < F.col("wanted"))
        .select(
            "sid", "turn", slot.alias("slot"), permuted(x, n, settings.seed, sid, turn).alias("block"),
            F.pmod(F.xxhash64(F.lit(settings.seed + 2), sid, slot), F.lit(settings.shards)).cast("int").alias("shard"),
            F.xxhash64(F.lit(settings.seed + 3), sid, slot).alias("place"),
        )
    )

    first, last = F.floor(F.col("at") / width), F.floor((F.col("at") + F.col("size") - 1) / width)
    end = F.col("at") + F.col("size")
    pieces = (
        dealt(rows.where("size > 0"), "sid", "part", "at").select("sid", "part", "at", "size", F.explode(F.sequence(first, last)).alias("k"))
        .join(cut.select("sid", "part", "offset"), ["sid", "part"])
        .select(
            "sid", "part", "at", (F.col("offset") + F.col("k")).alias("block"),
            (F.greatest(F.col("k") * width, F.col("at")) - F.col("at")).alias("lo"),
            (F.least((F.col("k") + 1) * width, end) - F.col("at")).alias("hi"),
        )
    )
    return Mixture(rows, pieces, slots)


def drawn(mixture: Mixture) -> DataFrame:
    """``sid, part, at, lo, hi, turn, shard, place``: pieces of rows in the blocks that are drawn."""
    # The slots come from few rows, by which Spark would judge them small enough to broadcast.
    return mixture.pieces.join(mixture.slots.hint("merge"), ["sid", "block"]).drop("block", "slot")


def taken(mixture: Mixture) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for each row: the words the mixture takes, repeats counted."""
    counted = drawn(mixture).groupBy("sid", "part", "at").agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"))
    rows = mixture.rows
    full = rows.where("size > 0").join(counted, ["sid", "part", "at"], "left")
    none = rows.where("size = 0").withColumn("taken", F.lit(0).cast("bigint"))
    return full.unionByName(none).select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_texts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """What the mixture takes, with the columns of ``docs``: a row for each document and turn.

    Its text is the words taken in that turn, joined by one space; the text as it is where
    all are. ``n_chars``, if there, is the length of the new text. Documents of which nothing is taken are gone.
    Repeated rows are documents of their own.
    """
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "source", "text"))
    mixture = mix(keyed.select("doc_id", "source", words_in(F.col("text")).alias("size"), "__key"), settings, ties=["__key"])
    place = ["sid", "part", "at"]
    spans = drawn(mixture).groupBy(*place, "turn").agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("__spans"), F.sum(F.col("hi") - F.col("lo")).alias("__words")
    )
    own = mixture.rows.where("size > 0").select(*place, F.col("more")["__key"].alias("__own"), F.col("size").alias("__size"))
    # The turns of a text together, so that its words are found once; rows of equal texts take turns of their own.
    turns = own.join(spans, place).groupBy("__own", "__size").agg(F.collect_list(F.struct("__spans", "__words")).alias("__turns"))
    whole = F.forall("__turns", lambda t: t["__words"] == F.col("__size"))
    words = F.when(~whole, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    taken = F.flatten(
        F.transform("__turn.__spans", lambda s: F.slice("__all", (s["lo"] + 1).cast("int"), (s["hi"] - s["lo"]).cast("int")))
    )
    text = F.when(F.col("__turn.__words") == F.col("__size"), F.col("text")).otherwise(F.array_join(taken, " "))
    found = keyed.dropDuplicates(["__key"]).join(turns, F.col("__key") == F.col("__own")).withColumn("__all", words)
    out = found.withColumn("__turn", F.explode("__turns")).withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
