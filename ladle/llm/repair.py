r"""Conversation structure repair: the cheapest edits that give each conversation legal turns.

A repaired conversation reads ``(s?(ua)+)?`` by the initials of its roles: perhaps a
system turn, then user and assistant turns by turns; or nothing at all. Edits are Keep,
Rerole, Delete and Insert; blank and repeated turns must go, truncated ones that
stay cost extra. Of the cheapest edits the ones whose initials are least in ASCII
order are taken.

Rows are dealt by conversation and sorted by turn by Spark, which marks repeated
turns with a window over the same partitions (no second shuffle). A task then
streams through them: the dynamic programme's state is a cost for each of the four
places in the pattern and the order of the four edit strings so far, so it goes over from
batch to batch. A step depends on the differences of the costs only, of which there
are few, and is looked up. Each row leaves four bytes of backpointers. A
conversation of more than ``CHUNK_ROWS`` rows (or ``CHUNK_CHARS`` of text) puts each
chunk's rows and backpointers into the shared folder; they are walked back from the last
chunk on and replayed from the first, so no conversation needs more memory than a chunk.

Edge cases: a null role or text is one space; a null turn comes first; rows of equal
turns go by role and text; rows with a null conversation form one of their own; an
empty table gives an empty result; other columns are dropped. Gaps beyond 2^63 - 1 are
given as that.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.llm.arrays import load, remove, save

RETURNED, DELETED, INSERTED, TRUNCATED = 3, 4, 3, 3
CHUNK_ROWS, CHUNK_CHARS = 200_000, 16_000_000
SPACE = " \t\n\x0b\x0c\r"

#: Places in the pattern: at its start, behind s, behind u, behind a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a kept turn leads by its initial; what isn't listed can't be kept.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Where a turn that is inserted or gets another role leads, and its role.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
FINAL = {START, ASSISTANT}
LEGAL = {"su", "ua", "au"}
EDITS = "DKR"
#: Inserting more than two turns in a row only leads back to a place passed before.
MOST_INSERTED = 2

#: Costs by place (None: out of reach) less the least of them, and the reached places in the order of their edit strings.
State = tuple[tuple[int | None, ...], tuple[int, ...]]
FIRST: State = ((0, None, None, None), (START,))


@lru_cache(maxsize=100_000)
def step(state: State, initial: str, gone: bool, truncated: bool) -> tuple[State, int, int]:
    """The state behind a row, what its least cost rose by, and a byte of backpointer for each place: place before, inserted turns, edit.

    Two strings of edits that lead through the same rows end in a row's edit, so none
    begins another: which is less doesn't change by what follows.
    """
    costs, order = state
    best: dict[int, tuple] = {}
    for rank, before in enumerate(order):
        place, cost = before, costs[before]
        for inserted in range(MOST_INSERTED + 1):
            ways = [("D", place, DELETED)]
            if not gone:
                more = TRUNCATED if truncated else 0
                ways.append(("R", NEXT[place], RETURNED + more))
                if (place, initial) in KEPT:
                    ways.append(("K", KEPT[place, initial], more))
            for edit, to, price in ways:
                found = (cost + price, rank, "I" * inserted + edit, before, inserted, edit)
                if to not in best or found < best[to]:
                    best[to] = found
            place, cost = NEXT[place], cost + INSERTED
    least = min(x[0] for x in best.values())
    back = 0
    for to, (_, _, _, before, inserted, edit) in best.items():
        back |= (before | inserted << 2 | EDITS.index(edit) << 4) << 8 * to
    reached = tuple(sorted(best, key=lambda to: best[to][1:3]))
    return (tuple(best[to][0] - least if to in best else None for to in range(4)), reached), least, back


def last(state: State) -> tuple[int, int, int]:
    """(cost above the least, place, turns inserted at the end) of the cheapest way to end."""
    costs, order = state
    found = []
    for rank, before in enumerate(order):
        place, cost, inserted = before, costs[before], 0
        while place not in FINAL:
            place, cost, inserted = NEXT[place], cost + INSERTED, inserted + 1
        found.append((cost, rank, before, inserted))
    cost, _, place, inserted = min(found)
    return cost, place, inserted


class _Chunk:
    """Rows (turn, role, text) that follow one another, and their backpointers."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.backs: list[int] = []
        self.chars = 0


class Conversation:
    """One conversation's rows, added in order; ``edits`` then gives its repaired turns."""

    def __init__(self, key: object, folder: str, chunk_rows: int, chunk_chars: int) -> None:
        self.key, self.folder, self.limits = key, f"{folder}/spill-{uuid.uuid4().hex}", (chunk_rows, chunk_chars)
        self.state, self.cost, self.chunk, self.spilled = FIRST, 0, _Chunk(), 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.least = self.most = None
        self.turns, self.initial = 0, None

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        if turn is not None and turn != self.most:
            self.least, self.most, self.turns = turn if self.least is None else self.least, turn, self.turns + 1
        end, initial = text.rstrip(SPACE)[-1:], role[:1]
        truncated = bool(end) and not repeated and end not in ".!?"
        self.blank += not end
        self.duplicate += bool(end) and repeated
        self.truncated += truncated
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL
        self.initial = initial
        self.state, rose, back = step(self.state, initial if initial in "sua" else "", not end or repeated, truncated)
        self.cost += rose
        chunk = self.chunk
        chunk.rows.append((turn, role, text))
        chunk.backs.append(back)
        chunk.chars += len(role) + len(text)
        if len(chunk.rows) >= self.limits[0] or chunk.chars >= self.limits[1]:
            self._spill()

    def _spill(self) -> None:
        rows = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*self.chunk.rows), (pa.int64(), pa.large_string(), pa.large_string()))],
                                          names=["turn", "role", "text"])
        with pa.BufferOutputStream() as out:
            with pa.ipc.new_stream(out, rows.schema) as writer:
                writer.write_batch(rows)
            save(self.folder, f"rows-{self.spilled}", np.frombuffer(out.getvalue(), np.uint8))
        save(self.folder, f"backs-{self.spilled}", np.array(self.chunk.backs, "<u4"))
        self.spilled += 1
        self.chunk = _Chunk()

    @property
    def gaps(self) -> int:
        return 0 if self.least is None else min(self.most - self.least + 1 - self.turns, (1 << 63) - 1)

    def _rows(self, at: int) -> list[tuple]:
        if at == self.spilled:
            return self.chunk.rows
        with pa.ipc.open_stream(pa.py_buffer(load(self.folder, f"rows-{at}", "u1"))) as source:
            return list(zip(*(c.to_pylist() for c in source.read_all().columns)))

    def edits(self) -> Iterator[tuple[str, int | None, str, str]]:
        """(edit, turn, role, text) in order, the rows to delete with what they held; an inserted turn has no number."""
        rest, place, at_end = last(self.state)
        self.cost += rest
        for at in range(self.spilled, -1, -1):
            backs = self.chunk.backs if at == self.spilled else load(self.folder, f"backs-{at}", "<u4").tolist()
            taken = bytearray(len(backs))
            for i in range(len(backs) - 1, -1, -1):
                own = backs[i] >> 8 * place & 255
                taken[i], place = own >> 2, own & 3
            if at == self.spilled:
                tail = taken
            else:
                save(self.folder, f"taken-{at}", np.frombuffer(bytes(taken), np.uint8))
        place = START
        for at in range(self.spilled + 1):
            taken = tail if at == self.spilled else load(self.folder, f"taken-{at}", "u1").tolist()
            for (turn, role, text), own in zip(self._rows(at), taken):
                for _ in range(own & 3):
                    place = NEXT[place]
                    yield "I", None, ROLE[place], ""
                edit = EDITS[own >> 2]
                if edit == "R":
                    place = NEXT[place]
                    role = ROLE[place]
                elif edit == "K":
                    place = KEPT[place, role[:1]]
                yield edit, turn, role, text
        for _ in range(at_end):
            place = NEXT[place]
            yield "I", None, ROLE[place], ""
        if self.spilled:
            remove(self.folder)


def _stream(turns: DataFrame, work: str, told: Callable[[Conversation], Iterator[tuple]], schema: T.StructType, chunk_rows: int, chunk_chars: int) -> DataFrame:
    """What ``told`` gives for each conversation, behind its key as text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, out = None, []

        def batch() -> pd.DataFrame:
            frame = pd.DataFrame(list(zip(*out)) and dict(zip(schema.fieldNames(), zip(*out))), columns=schema.fieldNames(), dtype=object)
            out.clear()
            return frame

        def finish(conversation: Conversation | None) -> Iterator[pd.DataFrame]:
            if conversation is not None:
                for row in told(conversation):
                    out.append((conversation.key, *row))
                    if len(out) >= 5000:
                        yield batch()

        for frame in frames:
            for key, turn, known, role, text, repeated in zip(*(frame[c] for c in ("conv", "turn", "known", "role", "text", "repeated"))):
                key = key if isinstance(key, str) else None
                if current is None or key != current.key:
                    yield from finish(current)
                    current = Conversation(key, work, chunk_rows, chunk_chars)
                current.add(int(turn) if known else None, role, text, repeated)
        yield from finish(current)
        if out:
            yield batch()

    rows = turns.select(turns["conv_id"].cast("string").alias("conv"), turns["turn"].cast("long").alias("at"),
                        F.coalesce(turns["role"], F.lit(" ")).alias("role"), F.coalesce(turns["text"], F.lit(" ")).alias("text"))
    same = F.row_number().over(W.partitionBy("conv", "role", "text").orderBy("at"))
    dealt = rows.repartition("conv").withColumn("repeated", same > 1).sortWithinPartitions("conv", "at", "role", "text")
    return dealt.select("conv", F.coalesce("at", F.lit(0)).alias("turn"), F.col("at").isNotNull().alias("known"), "role", "text", "repeated").mapInPandas(run, schema)


EDITED = T.StructType([T.StructField("conv_id", T.StringType()), T.StructField("step", T.LongType()), T.StructField("edit", T.StringType()),
                       T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def repair(turns: DataFrame, work: str, *, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(conv_id, step, edit, turn, role, text) of (conv_id, turn, role, text): every edit in order; without those of edit D, the repaired turns.

    ``work`` is a folder that all workers share; only conversations of several chunks use it.
    """

    def told(conversation: Conversation) -> Iterator[tuple]:
        for at, edit in enumerate(conversation.edits()):
            yield at, *edit

    found = _stream(turns, work, told, EDITED, chunk_rows, chunk_chars)
    return found.withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
AUDITED = T.StructType([T.StructField("conv_id", T.StringType()), *(T.StructField(x, T.LongType()) for x in COUNTS),
                        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])


def audit(turns: DataFrame, work: str, *, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """A row per conversation: its faults, what the repair costs, the initials of its edits, and a digest of the repaired turns."""

    def told(conversation: Conversation) -> Iterator[tuple]:
        letters, digest, first = bytearray(), hashlib.sha256(), True
        for edit, _, role, text in conversation.edits():
            letters += edit.encode()
            if edit != "D":
                digest.update(f"{role}:{text}".encode() if first else f"\n{role}:{text}".encode())
                first = False
        yield *(getattr(conversation, x) for x in COUNTS), letters.decode(), digest.hexdigest()

    found = _stream(turns, work, told, AUDITED, chunk_rows, chunk_chars)
    return found.withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults dealt by crc32 of ``conv_id:turn``: of 20 rows one each is dropped, emptied,
    robbed of its full stops, repeated, and given to the user."""

    def said(name: str) -> Column:
        return F.coalesce(turns[name].cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = turns.select(turns["conv_id"], turns["turn"], said("role").alias("role"), said("text").alias("text"), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(times).alias("time")).drop("time")
