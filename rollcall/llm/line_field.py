"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line is judged by its own look, by that of its neighbours and
by the labels next to it. Labels are known for documents only, so in training each line
takes the label of its document. The score of a document is the probability of "good" of
its lines, weighted by their lengths.

With two states, what one end of the chain says about a line is one number, the log odds;
forward and backward passes are recursions of that number over all documents of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.words import (
    buffers, covered, lines_of, repeats_in_groups, rolling, small, span_hashes, sums, windows, words_of,
)


@dataclass(frozen=True)
class Settings:
    """Parameters of the fit."""

    #: At most so many labelled documents are used, those whose ids hash lowest. Their texts
    #: are cut into runs of at most so many lines, and at most ``sample`` runs are used, chosen
    #: by a hash from all parts of the texts; a text of fewer lines is one run.
    sample: int = 3000
    run_lines: int = 300
    steps: int = 120
    rate: float = 0.1
    penalty: float = 1e-3


OWN = (
    "length", "words", "word_length", "symbols", "upper", "digits", "marks", "bars", "calls", "ended", "lower_start",
    "same_line", "same_words", "same_windows",
)
#: What is also read from the line before and the line after.
SHARED = ("length", "symbols", "upper", "marks", "bars", "calls", "same_line")
NAMES = (*OWN, *[f"{side}_{n}" for side in ("before", "after") for n in SHARED], "first", "last", "always")


def _flags(characters: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters)] = True
    return table


_UPPER, _DIGIT = _flags(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags(b"0123456789")
_SYMBOL, _BAR, _CALL = _flags(b"#*$%&<>\\^~`={}@_"), _flags(b"|"), _flags(b"!?")
_MARK, _END = _flags(b".,;:'\"()-"), _flags(b".!?:;\"'")


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line with a word, its bytes, and its document."""
    data, offsets = buffers(column)
    words = words_of(column)
    starts, ends, doc = lines_of(words, offsets)
    if not len(starts):
        return np.empty((0, len(NAMES))), starts, doc
    size = ends - starts
    bounds = np.stack([starts, ends], axis=1).ravel()

    def share(table: np.ndarray) -> np.ndarray:
        return sums(table[data], bounds)[::2] / size

    first = np.searchsorted(words.starts, starts)
    n_words = np.searchsorted(words.starts, ends) - first
    line_of_word = np.repeat(np.arange(len(starts)), n_words)
    hashes = words.hashes()
    at, window_doc = windows(words, 3)
    repeated = covered(at[repeats_in_groups(rolling(hashes, at, at + 3), window_doc)[0]], 3, len(hashes))
    same_word = repeats_in_groups(hashes, line_of_word)[1]
    word_bounds = np.append(first, len(hashes))
    last = data[words.ends[first + n_words - 1] - 1]
    head = data[words.starts[first]]
    own = {
        "length": np.log1p(size) / 5, "words": np.log1p(n_words) / 3,
        "word_length": sums(words.ends - words.starts, word_bounds) / n_words / 8,
        "symbols": share(_SYMBOL), "upper": share(_UPPER), "digits": share(_DIGIT), "marks": share(_MARK),
        "bars": share(_BAR), "calls": share(_CALL), "ended": _END[last].astype(float),
        "lower_start": ((head >= 97) & (head <= 122)).astype(float),
        "same_line": repeats_in_groups(span_hashes(data, starts, ends), doc)[0].astype(float),
        "same_words": sums(same_word, word_bounds) / n_words, "same_windows": sums(repeated, word_bounds) / n_words,
    }
    is_first = np.append(True, doc[1:] != doc[:-1])
    is_last = np.append(is_first[1:], True)
    columns = [own[n] for n in OWN]
    for edge, shift in ((is_first, 1), (is_last, -1)):
        columns += [np.where(edge, 0.0, np.roll(own[n], shift)) for n in SHARED]
    columns += [is_first.astype(float), is_last.astype(float), np.ones(len(starts))]
    return np.stack(columns, axis=1), size, doc


@dataclass(frozen=True)
class Model:
    """Weights for "good" against "bad", log potentials of neighbouring labels, and of the first one."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray
    start: float

    def evidence(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights


def _padded(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row per document; the mask tells what is there."""
    mask = np.arange(counts.max(initial=0)) < counts[:, None]
    out = np.zeros(mask.shape)
    out[mask] = values
    return out, mask


def _passed_on(odds: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Log odds of a neighbour, from those of a label and the potentials ``pairs[label, neighbour]``."""
    return np.logaddexp(pairs[0, 1], pairs[1, 1] + odds) - np.logaddexp(pairs[0, 0], pairs[1, 0] + odds)


def _messages(evidence: np.ndarray, counts: np.ndarray, pairs: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of each line given all up to it, and what the lines after it add."""
    ahead, back = np.zeros_like(evidence), np.zeros_like(evidence)
    width = evidence.shape[1]
    for t in range(width):
        ahead[:, t] = evidence[:, t] + (start if t == 0 else _passed_on(ahead[:, t - 1], pairs))
    for t in range(width - 2, -1, -1):
        said = _passed_on(evidence[:, t + 1] + back[:, t + 1], pairs.T)
        back[:, t] = np.where(t + 1 < counts, said, 0.0)
    return ahead, back


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def marginals(evidence: np.ndarray, counts: np.ndarray, pairs: np.ndarray, start: float, together: int = 64) -> np.ndarray:
    """Probability of "good" of each line; documents of similar length are passed together."""
    begins = np.cumsum(counts) - counts
    out = np.empty(len(evidence))
    order = np.argsort(counts, kind="stable")
    for lo in range(0, len(order), together):
        some = order[lo : lo + together]
        n = counts[some]
        at = np.repeat(begins[some], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        padded, mask = _padded(evidence[at], n)
        ahead, back = _messages(padded, n, pairs, start)
        out[at] = _sigmoid((ahead + back)[mask])
    return out


def fit(x: np.ndarray, counts: np.ndarray, labels: np.ndarray, settings: Settings = Settings()) -> Model:
    """Greatest likelihood by gradient ascent (Adam); documents are given one after the other.

    Without documents, or with one label only, the weights stay near zero.
    """
    mean, scale = (x.mean(axis=0), x.std(axis=0)) if len(x) else (np.zeros(len(NAMES)), np.ones(len(NAMES)))
    mean[-1], scale = 0.0, np.where(scale > 1e-6, scale, 1.0)
    theta, moment, square = (np.zeros(len(NAMES) + 5) for _ in range(3))
    if not len(counts):
        return Model(mean, scale, theta[:-5], theta[-5:-1].reshape(2, 2), 0.0)
    z, y = (x - mean) / scale, np.repeat(labels, counts).astype(float)
    begins = np.cumsum(counts) - counts
    inner = counts[:, None] > np.arange(1, counts.max())
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels, labels), counts - 1)
    for step in range(1, settings.steps + 1):
        pairs, start = theta[-5:-1].reshape(2, 2), theta[-1]
        padded, mask = _padded(z @ theta[:-5], counts)
        ahead, back = _messages(padded, counts, pairs, start)
        good = _sigmoid((ahead + back)[mask])
        joint = [
            pairs[a, b] + a * ahead[:, :-1] + b * (padded[:, 1:] + back[:, 1:]) for a in (0, 1) for b in (0, 1)
        ]
        joint = np.stack(joint)
        joint = np.exp(joint - joint.max(axis=0))
        expected = ((joint / joint.sum(axis=0)) * inner).sum(axis=(1, 2))
        gradient = np.concatenate([z.T @ (y - good), seen.ravel() - expected, [(labels - good[begins]).sum()]])
        gradient = gradient / len(counts) - settings.penalty * theta
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta = theta + settings.rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, theta[:-5], theta[-5:-1].reshape(2, 2), float(theta[-1]))


def _remainder() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    sample = (
        labels.where(_remainder() != 1).where("quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(settings.sample)
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            x, _, doc = features(batch.column("text"))
            x = x.astype(np.float32)
            begins = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            runs = [(i, lo, min(lo + settings.run_lines, b)) for i, (a, b) in enumerate(zip(begins[:-1], begins[1:])) for lo in range(a, b, settings.run_lines)]
            of = pa.array([i for i, _, _ in runs], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(of), batch.column("label").take(of), pa.array([lo - int(begins[i]) for i, lo, _ in runs], pa.int64()),
                    pa.array([hi - lo for _, lo, hi in runs], pa.int32()), pa.array([x[lo:hi].tobytes() for _, lo, hi in runs], pa.binary()),
                ],
                names=["doc_id", "label", "line", "n", "x"],
            )

    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    found = joined.select(F.col("doc_id").cast("bigint"), "label", "text").mapInArrow(look, "doc_id bigint, label int, line bigint, n int, x binary")
    # The same runs every time, also where ids repeat and where texts are very long.
    chosen = found.orderBy(F.xxhash64("doc_id", "line"), "doc_id", "line", "label", "x").limit(settings.sample)
    rows = sorted(chosen.collect(), key=lambda r: (r.doc_id, r.line, r.label, bytes(r.x)))
    x = np.frombuffer(b"".join(bytes(r.x) for r in rows), dtype=np.float32).reshape(-1, len(NAMES)).astype(np.float64)
    return fit(x, np.array([r.n for r in rows], dtype=np.int64), np.array([r.label for r in rows], dtype=np.int64), settings)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``."""
    empty = float(_sigmoid(np.array(model.start)))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            x, size, doc = features(batch.column("text"))
            counts = np.bincount(doc, minlength=batch.num_rows)
            there = counts[counts > 0]
            good = marginals(model.evidence(x), there, model.pairs, model.start)
            weight = np.bincount(doc, weights=size, minlength=batch.num_rows)
            total = np.bincount(doc, weights=size * good, minlength=batch.num_rows)
            scores = np.where(weight > 0, total / np.maximum(weight, 1), empty).clip(0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    scored = docs.select("doc_id", "text").mapInArrow(judge, "doc_id bigint, score double, predicted int")
    return scored.select("doc_id", F.coalesce(_remainder() == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fit on ``labels (doc_id, quality)`` and score every row of ``docs (doc_id, text)``.

    Only documents whose ``crc32(doc_id) % 3`` is not 1 are learned from. Labels other than
    0 and 1, and labels without a document, are ignored; a document labelled twice counts
    twice. A null id is neither held out nor learned from. A text without words gets the
    probability the first line of any text starts with. Repeated rows get equal scores; an
    empty table gives no rows, and without labels every score is 0.5.
    """
    return score(docs, train(docs, labels, settings))
