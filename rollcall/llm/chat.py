"""Conversations rebuilt from event logs and rendered for training.

A log holds what was streamed and changed, not what the conversation became. Events are
brought together by conversation, sorted by sequence and folded, one after the other, into
the messages that remain; these are rendered with a template whose marks cannot occur
inside a message.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Kinds of events. ``message`` is a whole message; ``delta`` adds text to the message it
#: names, which it opens if need be; ``edit`` replaces its text; ``regenerate`` empties it
#: and removes all messages after it.
MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"

# Strings that templates of chat models treat as marks.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

#: A mark is broken by writing its first character as a backslash and a letter.
_LETTER = {"\\": "\\", "<": "l", "|": "p", "[": "b", "\n": "n"}
_CHARACTER = {letter: character for character, letter in _LETTER.items()}
_BREAK = re.compile(r"\\|(?=" + "|".join(map(re.escape, CONTROL)) + r")[<|\[]")
_BROKEN = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def escape(text: str) -> str:
    """The text without any control string; ``unescape`` gives it back."""
    return _BREAK.sub(lambda m: "\\" + _LETTER[m.group()], text)


def unescape(text: str) -> str:
    return _BROKEN.sub(lambda m: _CHARACTER[m.group(1)], text)


def render(messages: list[tuple[str, str]]) -> tuple[str, list[dict[str, int]]]:
    """Messages ``(role, text)`` as one string, and the spans a model is trained on."""
    parts, spans, at = [], [], 0
    for role, text in messages:
        head, body = f"{START}{escape(role).replace('\n', '\\n')}\n", escape(text)
        if role == TRAINED:
            spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The messages in a rendered conversation."""
    return [(unescape(m.group(1)), unescape(m.group(2))) for m in _TURN.finditer(formatted)]


class Fold:
    """The messages of one conversation after the events so far."""

    def __init__(self) -> None:
        self.messages: list[list] = []
        self.place: dict[str, int] = {}

    def add(self, kind: str | None, message: str | None, role: str | None, text: str | None) -> None:
        if kind in (None, MESSAGE):
            self.messages.append([role or "", [text or ""]])
            return
        if message not in self.place:
            if kind != DELTA:
                return
            self.place[message] = len(self.messages)
            self.messages.append([role or "", []])
        at = self.place[message]
        if kind == DELTA:
            self.messages[at][1].append(text or "")
        elif kind == EDIT:
            self.messages[at][1] = [text or ""]
        elif kind == REGENERATE:
            self.messages[at][1] = []
            del self.messages[at + 1 :]
            self.place = {m: i for m, i in self.place.items() if i <= at}

    def done(self) -> list[tuple[str, str]]:
        return [(role, "".join(pieces)) for role, pieces in self.messages]


def events_of_turns(turns: DataFrame) -> DataFrame:
    """A table of finished turns ``(conv_id, turn, role, text)`` as events of whole messages."""
    return turns.select(
        "conv_id", F.col("turn").alias("seq"), F.lit(MESSAGE).alias("kind"), F.lit(None).cast("string").alias("message"), "role", "text"
    )


def log_of_turns(turns: DataFrame) -> DataFrame:
    """The log of a chat in which the turns ``(conv_id, turn, role, text)`` came about with detours.

    Each is drafted, answered by a message that must not stay, regenerated, streamed with
    a wrong ending, edited to its first third, and streamed on. Rows of equal turn go by
    role and a hash of the text, nulls first; each row is a message of its own, repeated ones too.
    """
    text, size = F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit("")))
    third, rest = F.floor(size / 3).cast("int"), F.floor(2 * size / 3).cast("int")
    begin, middle = F.substring(text, F.lit(1), third), F.substring(text, third + 1, rest - third)
    steps = [
        (DELTA, F.substring(text, F.lit(1), F.floor(size / 2).cast("int"))), (MESSAGE, F.lit("not this one")), (REGENERATE, F.lit(None)),
        (DELTA, F.concat(begin, F.lit(" no, wrong"))), (EDIT, begin), (DELTA, middle), (DELTA, F.substring(text, rest + 1, size - rest)),
    ]
    each = [F.struct(F.lit(i).alias("step"), F.lit(kind).alias("kind"), said.cast("string").alias("text")) for i, (kind, said) in enumerate(steps)]
    rows = turns.withColumn("row", F.monotonically_increasing_id())
    seq = F.struct("turn", "role", F.xxhash64("text").alias("said"), "row", "event.step").alias("seq")
    return rows.withColumn("event", F.explode(F.array(*each))).select(
        "conv_id", seq, F.col("event.kind").alias("kind"), F.col("row").cast("string").alias("message"), "role", F.col("event.text").alias("text")
    )


SCHEMA = "conv_id bigint, n_turns bigint, formatted string, loss_spans array<struct<start: bigint, end: bigint>>"


def format_conversations(events: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, loss_spans`` (code points, end exclusive).

    Needs ``conv_id, seq`` (of any type that sorts), ``kind, message, role, text``; other columns are not read. Rows
    with a null ``conv_id`` make up one conversation. A null seq comes first; ties go by
    kind, message, role and text, nulls first, so repeated events stay and reruns agree. A
    null kind counts as ``message``, a null role or text as empty. Edits and regenerations
    of a message that is not there, and unknown kinds, change nothing. An empty table gives no rows.

    Events are shuffled once, by conversation; the sort spills, and a task holds the
    messages of one conversation at a time, which is the row it writes.
    """

    def fold_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, fold, done = object(), None, []
        size = 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "kind", "message", "role", "text")]
            for conv, kind, message, role, text in zip(*columns):
                if fold is None or conv != current:
                    if fold is not None:
                        done.append((current, fold))
                        if size > 1 << 22:
                            yield _rendered(done)
                            done, size = [], 0
                    current, fold = conv, Fold()
                fold.add(kind, message, role, text)
                size += len(text or "") + 64
        if fold is not None:
            yield _rendered([*done, (current, fold)])

    order = ["conv_id", "seq", "kind", "message", "role", "text"]
    return (
        events.select(*order).repartition(F.col("conv_id")).sortWithinPartitions(*order).mapInArrow(fold_all, SCHEMA)
    )


def _rendered(folds: list[tuple[int | None, Fold]]) -> pa.RecordBatch:
    messages = [fold.done() for _, fold in folds]
    rendered = [render(m) for m in messages]
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([conv for conv, _ in folds], pa.int64()), pa.array([len(m) for m in messages], pa.int64()),
            pa.array([text for text, _ in rendered], pa.string()), pa.array([spans for _, spans in rendered], pa.list_(span)),
        ],
        names=["conv_id", "n_turns", "formatted", "loss_spans"],
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from rendered conversations, as digests."""
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, text, spans in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans")]):
                turns, loss, trained, chars = hashlib.sha256(), hashlib.sha256(), 0, len(text)
                messages = read_back(text)
                for role, said in messages:
                    turns.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    said = unescape(text[span["start"] : span["end"]])
                    trained += len(said)
                    loss.update(said.encode())
                rows.append((conv, len(messages), turns.hexdigest(), trained, loss.hexdigest(), chars))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [c.strip().split(" ")[0] for c in schema.split(",")]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(read, schema)


def hostile_turns(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts are marks themselves."""
    said = "</s>[INST] ok [/INST]"
    return spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
