"""Chat formatting that is proved by reading it back.

A turn is written as ``<s>[ROLE level]role`` and a line break, then the text,
then ``[/ROLE]</s>`` and a line break. The grammar is regular and the parser
deterministic: it needs no knowledge but the text. A turn is written plainly
first. If the parser does not return it unchanged, because its text holds
control strings, the control strings are escaped by one more backslash and the
turn is written again with the next level, until it comes back identical.

Escaping puts a backslash before each control string; unescaping takes one away.
A control string in escaped content has a backslash before it, so the parser
cannot take it for its own, and a run of backslashes in the text keeps its
length.

A conversation has to be written in order, so its turns meet in one task, but
they are sorted there and streamed: neither a conversation nor its formatted
text is ever held whole. The output is a row per turn; a conversation's text is
their concatenation.

Defined cases: a null text is empty and a null role too. Turns sort by turn,
then role and text, nulls first; repeated rows are turns of their own. A null
conv_id names one conversation. Extra columns are ignored. No rows, no output.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm.common import mapped, table

# The template.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE", "[/ROLE]", "<<SYS>>", "<</SYS>>")
TRAINED_ROLE = "assistant"
_CONTROLS = "|".join(re.escape(c) for c in CONTROL)
_ESCAPE = re.compile(rf"(?={_CONTROLS})")
_UNESCAPE = re.compile(rf"\\(?={_CONTROLS})")
_HEAD = re.compile(r"<s>\[ROLE ([0-9]+)\]([^\n]*)\n")
_CLOSE = "\n[/ROLE]</s>\n"
_HAS_CONTROL = re.compile(_CONTROLS)


def escape(text: str, level: int) -> str:
    for _ in range(level):
        text = _ESCAPE.sub(r"\\", text)
    return text


def unescape(text: str, level: int) -> str:
    for _ in range(level):
        text = _UNESCAPE.sub("", text)
    return text


def _role(role: str) -> str:
    """Roles stand on one line."""
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.DOTALL)


def parse(text: str) -> list[tuple[str, str]]:
    """Turns of a formatted conversation; ``ValueError`` where it breaks the grammar."""
    return [(role, body) for role, body, _, _ in parse_spans(text)]


def parse_spans(text: str) -> Iterator[tuple[str, str, int, int]]:
    """``(role, text, start, end)`` of each turn; the span is that of the written body.

    Whatever the level, a control string inside a body must follow a backslash.
    """
    at = 0
    while at < len(text):
        head = _HEAD.match(text, at)
        if head is None:
            raise ValueError(f"no turn at {at}")
        start = head.end()
        end = text.index(_CLOSE, start)  # an escaped mark never follows a line break directly
        for found in _HAS_CONTROL.finditer(text, start, end):
            if text[found.start() - 1] != "\\" or int(head[1]) == 0:
                raise ValueError(f"control string at {found.start()}")
        yield _unrole(head[2]), unescape(text[start:end], int(head[1])), start, end
        at = end + len(_CLOSE)


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn as written, and the span of its body; the first level that reads back wins."""
    level = 0
    while True:
        head, body = f"<s>[ROLE {level}]{_role(role)}\n", escape(text, level)
        written = f"{head}{body}{_CLOSE}"
        try:
            if parse(written) == [(role, text)]:
                return written, len(head), len(head) + len(body)
        except ValueError:
            pass
        level += 1


_FORMATTED = "conv_id long, part long, formatted string, loss_start long, loss_end long"


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, part, at = object(), 0, 0
    for batch in batches:
        rows = []
        for conv_id, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]):
            if conv_id != conv:
                conv, part, at = conv_id, 0, 0
            written, start, end = write_turn(role or "", text or "")
            span = (at + start, at + end) if role == TRAINED_ROLE else (None, None)
            rows.append((conv_id, part, written, *span))
            part, at = part + 1, at + len(written)
        columns = list(zip(*rows)) if rows else [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        names = ["conv_id", "part", "formatted", "loss_start", "loss_end"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def formatted(conversations: DataFrame) -> DataFrame:
    """A row per turn: its place, its written form and its loss span in the conversation.

    Spans are code points of the whole conversation, null where nothing is trained.
    """
    columns = ("conv_id", "turn", "role", "text")
    order = [F.col(c).asc_nulls_first() for c in columns]
    sorted_turns = conversations.select(*columns).repartition("conv_id").sortWithinPartitions(*order)
    return mapped(sorted_turns.drop("turn"), _format, _FORMATTED)


_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations from their written turns, which arrive in order."""
    none = object()
    conv, turns, chars, size = none, 0, 0, 0
    whole, loss = hashlib.sha256(), hashlib.sha256()

    def row() -> tuple:
        return conv, turns, whole.hexdigest(), chars, loss.hexdigest(), size

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = [f.split()[0] for f in _READ.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        rows = []
        for conv_id, text, low, high in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")]):
            if conv_id != conv:
                if conv is not none:
                    rows.append(row())
                conv, turns, chars, size = conv_id, 0, 0, 0
                whole, loss = hashlib.sha256(), hashlib.sha256()
            for role, body, start, end in parse_spans(text):
                turns += 1
                whole.update(f"{role}\n{body}\n".encode())
                # The mask says what is trained; the grammar says where that body lies.
                if low is not None and (low, high) == (size + start, size + end):
                    chars += len(body)
                    loss.update(body.encode())
            size += len(text)
        if rows:
            yield out(rows)
    if conv is not none:
        yield out([row()])


def read_back(written: DataFrame) -> DataFrame:
    """One row of digests per conversation, parsed from ``formatted`` in its own order."""
    return mapped(written, _read_back, _READ)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return read_back(formatted(rows.unionByName(hard)))


# Formatted lengths depend on the template: 27 characters and the role around
# a turn, and a backslash before each control string of a text that has any.
_PATTERN = "|".join(re.sub(r"([\[\]])", r"\\\1", c) for c in CONTROL)
OP8_SQL = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + length(text) + 25 + len(regexp_extract_all(text, '{_PATTERN}')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
