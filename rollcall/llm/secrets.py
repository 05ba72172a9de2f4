"""Secrets in texts: known forms by pattern, random strings by token efficiency.

A vocabulary of byte pairs spells ordinary words and names with few tokens. A random
string of the same length needs many, so few characters per token give it away. Digests
and identifiers also look odd to a vocabulary; they are known forms and left out. What
makes an identifier is that its runs of letters are words: in lower case, each on its own,
the vocabulary spells them with few tokens.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from rollcall.llm.words import small

#: Where the vocabulary lies on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Kind, pattern, group whose length counts, least length.
BASE = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
RANDOM = "random"
KINDS = [kind for kind, _, _, _ in BASE] + [RANDOM]

# Splitting rule of the vocabulary: a word with the space before it, a number, or signs.
_PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_HEX = re.compile(r"[0-9A-Fa-f]+")
#: Hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
_DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
_LETTERS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Characters spelled at a time, so that a blob of any length takes time in proportion.
SLICE = 4096


@dataclass(frozen=True)
class Rules:
    """Parameters of the token test."""

    vocabulary: str = VOCABULARY
    min_length: int = 20
    #: At most so many characters per token.
    max_ratio: float = 2.0
    #: Letter runs are words from this mean length on, and from so many letters per token.
    word_length: float = 3.0
    word_ratio: float = 2.2


@lru_cache(maxsize=4)
def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary in a file of base64 tokens and ranks; read once per Python worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("file", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})


def known_form(string: str, rules: Rules, tokens: Callable[[str], int]) -> bool:
    """Whether a string is a digest, a UUID, a number, or an identifier made of words."""
    if string.isdigit() or _UUID.fullmatch(string):
        return True
    if len(string) in _DIGEST_LENGTHS and _HEX.fullmatch(string):
        return True
    runs = _LETTERS.findall(string)
    letters, digits = sum(map(len, runs)), sum(c.isdigit() for c in string)
    if not runs or letters < rules.word_length * len(runs) or 2 * digits > len(string):
        return False
    return letters >= rules.word_ratio * sum(tokens(" " + run.lower()) for run in runs)


def finder(rules: Rules) -> Callable[[str], list[tuple[int, str, int]]]:
    """A function from a text to its spans ``(start, kind, end)`` in order."""
    # Only ASCII letters count as the same in either case.
    base = [(k, re.compile(p, re.ASCII | (re.IGNORECASE if k == "assign" else 0)), g, n) for k, p, g, n in BASE]
    strings = re.compile(rf"[A-Za-z0-9+/_=-]{{{rules.min_length},}}")
    encode = encoder(rules.vocabulary).encode_ordinary
    rank = {kind: i for i, kind in enumerate(KINDS)}

    def tokens(string: str) -> int:
        return sum(len(encode(string[a : a + SLICE])) for a in range(0, len(string), SLICE))

    def find(text: str) -> list[tuple[int, str, int]]:
        spans = [
            (m.start(), kind, m.end()) for kind, pattern, group, least in base
            for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least
        ]
        starts, furthest = [], []
        for start, _, end in sorted(spans):
            starts.append(start)
            furthest.append(max(end, furthest[-1] if furthest else 0))
        for m in strings.finditer(text):
            string, before = m.group(), bisect_left(starts, m.end())
            if before and furthest[before - 1] > m.start():
                continue
            if len(string) <= rules.max_ratio * tokens(string) and not known_form(string, rules, tokens):
                spans.append((m.start(), RANDOM, m.end()))
        return sorted(spans, key=lambda s: (s[0], rank[s[1]]))

    return find


def listed(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_random bigint"


def scan(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Spans of each text, one row per input row; places are code points, the end is exclusive.

    Needs ``doc_id`` and ``text``; other columns are not read. A null or empty text has no
    spans: counts are zero, ``spans`` is empty and the digest is that of nothing. The token
    test adds spans where no pattern matches and never takes one away. Repeated rows get
    equal results. Nothing is shuffled; each text is scanned whole.
    """

    def find_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder(rules)
        for batch in small(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                spans = find(text or "")
                base = [s for s in spans if s[1] != RANDOM]
                kinds = [kind for _, kind, _ in spans]
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append([*[kinds.count(k) for k in KINDS[:3]], digest, listed(spans), kinds.count(RANDOM)])
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]],
                names=[c.strip().split(" ")[0] for c in SCHEMA.split(",")],
            )

    return docs.select("doc_id", "text").mapInArrow(find_all, SCHEMA)
