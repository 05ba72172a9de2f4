"""Url verdicts by rules and by a cascade of Bloom filters.

A Bloom filter of the listed hosts also passes a few others. Which ones is known, since all
hosts of the corpus are: they go into a second filter, the listed hosts that pass the second
one into a third, and so on, until nothing passes by mistake. For any host of the corpus the
first filter that it fails tells whether it is listed. All filters together take a few bits
per listed host, so they are handed to every task and the pages are joined with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.session import pin

ALLOW, BLOCK = "allow", "block"
_WORD_BITS = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, all its subdomains, and paths that begin so."""

    verdict: str
    host: str
    path: str

    @property
    def shown(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``; A-Z in lower case."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _within(host: Column, domain: str) -> Column:
    return (host == domain) | F.endswith(host, F.lit("." + domain))


def matched(rules: Sequence[Rule], host: Column, path: Column, value: str) -> Column:
    """``shown`` or ``verdict`` of the longest rule that fits; of equally long ones that of the longer host."""
    ordered = sorted(rules, key=lambda r: (-len(r.shown), -len(r.host), r.verdict))
    fits = [
        F.when(_within(host, r.host) & F.startswith(path, F.lit(r.path)), F.lit(getattr(r, value))) for r in ordered
    ]
    return F.coalesce(*fits, F.lit(None).cast("string"))


@dataclass(frozen=True)
class Level:
    """One filter: a table of one row, bits in all, and hashes per key."""

    table: DataFrame
    bits: int
    hashes: int
    number: int

    def passes(self, key: Column) -> Column:
        words = self.table.select("words").scalar()
        out = F.lit(True)
        for i in range(self.hashes):
            at = _place(key, self.number, i, self.bits)
            out = out & (F.getbit(F.get(words, (at / _WORD_BITS).cast("int")), (at % _WORD_BITS).cast("int")) == 1)
        return out


def _place(key: Column, number: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(number), F.lit(i)), F.lit(bits).cast("bigint"))


def _level(keys: DataFrame, n: int, rate: float, number: int) -> Level:
    """A filter of ``keys (key)``, ``n`` in number, that passes others at about ``rate``."""
    hashes = max(1, round(-math.log2(rate)))
    bits = max(1, math.ceil(n * hashes / math.log(2) / _WORD_BITS)) * _WORD_BITS
    places = keys.select(F.explode(F.array(*[_place(F.col("key"), number, i, bits) for i in range(hashes)])).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % _WORD_BITS).cast("int"))
    filled = places.groupBy((F.col("at") / _WORD_BITS).cast("int").alias("word")).agg(F.bit_or(bit).alias("value"))
    empty = keys.sparkSession.range(bits // _WORD_BITS).select(
        F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("value")
    )
    words = filled.unionByName(empty).groupBy("word").agg(F.bit_or("value").alias("value"))
    row = words.agg(F.array_sort(F.collect_list(F.struct("word", "value"))).alias("w")).select(F.col("w.value").alias("words"))
    return Level(pin(row, "filter"), bits, hashes, number)


class Cascade:
    """Exact membership of the keys of a universe in a listed part of it."""

    def __init__(self, levels: Sequence[Level]) -> None:
        self.levels = list(levels)

    @classmethod
    def build(cls, listed: DataFrame, others: DataFrame) -> Cascade:
        """From ``listed (key)`` and ``others (key)``, both distinct and without nulls.

        Only counts reach the driver. The first filter passes about as many others as
        there are listed keys, each further level halves what is left, so the levels are
        about as many as the logarithm of the list's length, and their bits are a small
        multiple of it times the logarithm of how many others there are for each.
        """
        levels: list[Level] = []
        mine, theirs = pin(listed, "keys"), pin(others, "keys")
        n, against = mine.count(), theirs.count()
        rate = min(0.5, math.sqrt(0.5) * n / against) if against else 0.5
        while n:
            level = _level(mine, n, rate, len(levels))
            levels.append(level)
            passed = pin(theirs.where(level.passes(F.col("key"))), "keys") if against else theirs
            mine, theirs, n, against, rate = passed, mine, passed.count() if against else 0, n, 0.5
        return cls(levels)

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            # Failing an even level means not listed, failing an odd one listed.
            out = F.when(level.passes(key), out).otherwise(F.lit(level.number % 2 == 1))
        return out


def _domains(host: Column) -> Column:
    """A host and all domains it lies in."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def cascade_of_hosts(hosts: DataFrame, listed: DataFrame) -> Cascade:
    """A cascade over the distinct ``hosts (host)``: listed are those within a domain of ``listed (domain)``."""
    universe = hosts.where("host <> ''").select("host").distinct()
    universe = pin(universe, "hosts")
    domains = listed.select("domain").where("domain is not null").distinct()
    hit = (
        universe.select(F.col("host").alias("key"), F.explode(_domains(F.col("host"))).alias("domain"))
        .join(domains, "domain", "left_semi").select("key").distinct()
    )
    hit = pin(hit, "hosts")
    rest = universe.select(F.col("host").alias("key")).join(hit, "key", "left_anti")
    return Cascade.build(hit, rest)


def judge(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` for each row of ``pages (page_id, url)``.

    Where no rule fits, pages of listed domains are blocked and all others allowed.
    Other columns are not read. A url that is null or has no ``://`` has an empty host and
    path, which no rule with a host fits and no list holds. Repeated rows stay. Without
    listed domains, or without pages, there is no filter and nothing is listed.
    """
    found = pages.select("page_id", host_of(F.coalesce("url", F.lit(""))).alias("host"), path_of(F.coalesce("url", F.lit(""))).alias("path"))
    cascade = cascade_of_hosts(found.select("host"), listed)
    host, path = F.col("host"), F.col("path")
    return found.withColumn("listed", (host != "") & cascade.contains(host)).select(
        "page_id", "host", "path", matched(rules, host, path, "shown").alias("rule"),
        F.coalesce(matched(rules, host, path, "verdict"), F.when(F.col("listed"), BLOCK).otherwise(ALLOW)).alias("verdict"),
        "listed",
    )


def domain_table(spark: SparkSession, domains: Sequence[str]) -> DataFrame:
    """A list that is given in the code, as a table."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, domains))).alias("domain"))
