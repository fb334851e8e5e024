r"""Chat formatting: a finite-state machine over roles, segments with loss flags, a declarative template.

Each turn becomes three segments: an opening mark with the role, the text, and a
closing mark. Texts of the roles under loss bear the loss flag, nothing else does.
Inside texts and roles every ``<|`` gets a backslash (``<\|``, and one more where
there are some already), so no text can hold a control string, and reading back
takes exactly that backslash away.

The machine runs through each conversation in turn order as a stream: the rows
arrive sorted, one state is held, and a conversation of any length needs no more
memory than a row. Turns that no transition allows are flagged, and formatted all
the same.

Edge cases: a null text or role is the empty text; rows of one conversation with
equal turns go by role and text; rows with a null conversation form one of their
own; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTROL = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<\\(\\*)\|")


@dataclass(frozen=True)
class Template:
    """Marks, the roles under loss, and the machine: from each state (the last role, "" at first) the roles that may follow."""

    open_turn: str = "<|im_start|>"
    after_role: str = "\n"
    close_turn: str = "<|im_end|>\n"
    line_break: str = "<|br|>"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, frozenset[str]] = field(default_factory=lambda: {
        "": frozenset({"system", "user"}), "system": frozenset({"user"}), "user": frozenset({"assistant"}),
        "assistant": frozenset({"user", "tool"}), "tool": frozenset({"assistant", "tool"})})
    last: frozenset[str] = frozenset({"assistant"})

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        name = escape(role).replace(self.after_role, self.line_break)
        return [(f"{self.open_turn}{name}{self.after_role}", False), (escape(text), role in self.loss_roles), (self.close_turn, False)]

    def parse(self, formatted: str) -> tuple[str, str]:
        """Role and text of a formatted turn."""
        head, _, rest = formatted.removeprefix(self.open_turn).partition(self.after_role)
        return unescape(head.replace(self.line_break, self.after_role)), unescape(rest.removesuffix(self.close_turn))


CHATML = Template()


def escape(text: str) -> str:
    return CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


SEGMENTS = T.ArrayType(T.StructType([T.StructField("text", T.StringType(), False), T.StructField("loss", T.BooleanType(), False)]), False)
FORMATTED = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("position", T.LongType(), False), T.StructField("allowed", T.BooleanType(), False),
                          T.StructField("segments", SEGMENTS, False)])
ARROW_SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))


def format_turns(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """(conv_id, position, allowed, segments) of each row of (conv_id, turn, role, text); position counts from 0 in turn order."""

    def format_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, position = object(), "", 0
        for rows in batches:
            out: list[tuple] = []
            for conv, role, text in zip(*(rows.column(i).to_pylist() for i in (0, 2, 3))):
                if conv != current:
                    current, state, position = conv, "", 0
                out.append((position, role in template.follows.get(state, ()), [{"text": t, "loss": x} for t, x in template.segments(role, text)]))
                state, position = role or "?", position + 1
            columns = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.bool_()),
                                              pa.array(columns[2], ARROW_SEGMENTS)], names=FORMATTED.fieldNames())

    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(format_batches, FORMATTED)


READ_BACK = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                          T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
                          T.StructField("valid", T.BooleanType())])


def digests(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """What reading the formatted turns back gives, one row per conversation; ``valid`` if every turn is allowed and the last may end it."""

    class Reading:
        def __init__(self, conv: int | None) -> None:
            self.conv, self.n, self.loss, self.chars, self.valid, self.role = conv, 0, 0, 0, True, ""
            self.turns, self.under_loss = hashlib.sha256(), hashlib.sha256()

        def add(self, allowed: bool, segments: list[dict]) -> None:
            formatted = "".join(s["text"] for s in segments)
            self.role, text = template.parse(formatted)
            self.turns.update(f"{self.role}\n{text}\n".encode())
            for segment in segments:
                if segment["loss"]:
                    own = unescape(segment["text"])
                    self.under_loss.update(own.encode())
                    self.loss += len(own)
            self.n, self.chars, self.valid = self.n + 1, self.chars + len(formatted), self.valid and allowed

        def row(self) -> tuple:
            return (self.conv, self.n, self.turns.hexdigest(), self.loss, self.under_loss.hexdigest(), self.chars, self.valid and self.role in template.last)

    def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reading, out = None, []

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=READ_BACK.fieldNames())

        for rows in batches:
            for conv, allowed, segments in zip(*(rows.column(i).to_pylist() for i in (0, 2, 3))):
                if reading is None or reading.conv != conv:
                    if reading is not None:
                        out.append(reading.row())
                    reading = Reading(conv)
                reading.add(allowed, segments)
            if len(out) > 10_000:
                yield batch()
                out.clear()
        if reading is not None:
            out.append(reading.row())
        if out:
            yield batch()

    return formatted.select(*FORMATTED.fieldNames()).repartition("conv_id").sortWithinPartitions("conv_id", "position").mapInArrow(read_batches, READ_BACK)
