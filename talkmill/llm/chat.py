"""Chat formatting: a finite-state machine over roles and a declarative template."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, ready

#: Rows and characters of a batch that a worker hands back, about.
BATCH_ROWS, BATCH_CHARS = 4096, 4 << 20


@dataclass(frozen=True)
class Template:
    """How turns are written, which roles may follow which, and which roles' texts count for the loss.

    A turn is written open + role + colon, the text, close. In roles and texts, escape goes before each escape and each control string; in roles before the colon's first character too. No control string then stands unescaped but where a turn starts or ends, and dropping each escape gives the text back. A template for which that can't hold raises ValueError.
    """

    open: str = "### "
    colon: str = ": "
    close: str = " </turn>\n"
    escape: str = "\\"
    controls: tuple[str, ...] = ("###", "</turn>")
    shown: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss: tuple[str, ...] = ("assistant",)
    start: str = "begin"
    #: State and role to the next state. What is not here is out of turn.
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {("begin", "system"): "system", ("begin", "user"): "user", ("system", "user"): "user", ("user", "assistant"): "assistant", ("assistant", "user"): "user"})
    #: States in which a conversation may end.
    ends: tuple[str, ...] = ("user", "assistant")

    def __post_init__(self) -> None:
        if len(self.escape) != 1 or any(self.escape in x for x in (self.open, self.colon, self.close, *self.controls)):
            raise ValueError("escape must be one character that the template doesn't use otherwise")
        if not self.colon or not all(self.controls) or len(set(self.shown.values())) < len(self.shown) or any(v.startswith("=") for v in self.shown.values()):
            raise ValueError("colon and controls must not be empty, and shown roles must differ and not start with =")
        controls = "|".join(map(re.escape, sorted(self.controls, key=len, reverse=True)))
        e = re.escape(self.escape)
        put = object.__setattr__
        put(self, "_marks", re.compile(f"{e}|(?={controls})"))
        put(self, "_role_marks", re.compile(f"{e}|{re.escape(self.colon[0])}|(?={controls})"))
        put(self, "_plain", re.compile(f"{e}(.)", re.S))
        put(self, "_head", re.compile(f"{re.escape(self.open)}((?:[^{e}{re.escape(self.colon[0])}]|{e}.)*+){re.escape(self.colon)}", re.S))
        put(self, "_next", re.compile(f"{e}.|({controls})", re.S))
        found = [re.search(controls, x) if self.controls else None for x in (self.open, self.close)]
        if not all(found):
            raise ValueError("open and close must hold a control")
        put(self, "_control_at", found[1].start())
        for c in self.controls:  # an unfinished control at the end of a text must not become one by what follows
            for i in range(1, len(c)):
                if re.search(controls, c[:i] + self.close).start() < i + found[1].start():
                    raise ValueError(f"{c!r} can be finished by the close")

    def escaped(self, text: str) -> str:
        return self._marks.sub(lambda m: self.escape + m[0], text)

    def plain(self, text: str) -> str:
        return self._plain.sub(r"\1", text)

    def turn(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The turn's segments and whether they count for the loss; the text has a segment of its own."""
        name = self._role_marks.sub(lambda m: self.escape + m[0], self.shown.get(role, "=" + role if role in self.shown.values() or role.startswith("=") else role))
        return [(self.open + name + self.colon, False), (self.escaped(text), role in self.loss), (self.close, False)]

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of each turn of a formatted text, in one walk from mark to mark; raises ValueError if anything else stands in it."""
        back = {v: k for k, v in self.shown.items()}
        out, at = [], 0
        while at < len(formatted):
            head = self._head.match(formatted, at)
            if not head:
                raise ValueError(f"no turn at {at}")
            body = end = head.end()
            mark = self._next.search(formatted, body)
            while mark and not mark[1]:  # an escape and what it stands before
                end = mark.end()
                mark = self._next.search(formatted, end)
            close = mark.start() - self._control_at if mark else -1
            if close < end or not formatted.startswith(self.close, close):
                raise ValueError(f"the turn at {at} has no end")
            name = self.plain(head[1])
            out.append((back.get(name) or (name[1:] if name.startswith("=") else name), self.plain(formatted[body:close])))
            at = close + len(self.close)
        return out


SEGMENTS = "turn_no long, state string, in_order boolean, segment_no int, text string, loss boolean"


def format_turns(conversations: DataFrame, template: Template = Template(), *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The segments of all conversations, in order within each and each whole in one partition: conv_id, turn_no (from 0), state (after the turn), in_order, segment_no (in the turn), text, loss.

    Rows are dealt by conversation and sorted by (conversation, turn, role, text); each task then walks through its rows one by one, so that no conversation is held in memory. The machine takes each role in turn. A role that the state doesn't allow gives in_order false and leads to the state that it leads to elsewhere; such turns are formatted like others, and conversations with them can be told apart by the flag. A conversation's last state tells whether it may end there (Template.ends).

    Null text counts as empty, null role as the role "". Null turns come first. Turns with equal numbers go by role, then text; rows that repeat are as many turns. Rows with a null conversation are one conversation. An empty table gives no rows. Columns besides the four are not read.
    """
    ready(conversations.sparkSession)
    kind = conversations.schema[id_col].dataType.simpleString()
    pick = lambda name, to: F.col(f"`{name}`").alias(to)
    df = conversations.select(pick(id_col, "conv_id"), pick(turn_col, "turn"), F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    df = df.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text")
    entered = {role: state for (_, role), state in template.moves.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, first, state, no = None, True, template.start, 0
        for batch in batches:
            ids, out, held = batch.column(0), [], 0
            at: list[int] = []
            for i, (conv, role, text) in enumerate(zip(ids.to_pylist(), batch.column(2).to_pylist(), batch.column(3))):
                if first or conv != before:
                    before, first, state, no = conv, False, template.start, 0
                following = template.moves.get((state, role))
                state = following or entered.get(role, state)
                for k, (part, loss) in enumerate(template.turn(role, text.as_py())):
                    out.append((no, state, following is not None, k, part, loss))
                    at.append(i)
                    held += len(part)
                no += 1
                if len(out) >= BATCH_ROWS or held >= BATCH_CHARS:
                    yield _batch(ids, at, out)
                    out, at, held = [], [], 0
            if out:
                yield _batch(ids, at, out)

    def _batch(ids: pa.Array, at: list[int], out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.bool_(), pa.int32(), pa.string(), pa.bool_()]
        return pa.RecordBatch.from_arrays([ids.take(pa.array(at)), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], ["conv_id", "turn_no", "state", "in_order", "segment_no", "text", "loss"])

    out = df.mapInArrow(lean(run), f"conv_id {kind}, {SEGMENTS}")
    return out if id_col == "conv_id" else out.withColumnRenamed("conv_id", id_col)


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """What format_turns wrote, read back from its output alone, one row per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, in_order, ended (in a state that allows it), error.

    Segments are joined turn by turn and parsed by the template; digests grow along, so that memory holds one turn. A turn that can't be read is passed over; error tells of the conversation's first such one, and is null without any.
    """
    ready(segments.sparkSession)
    kind = segments.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, began, parts, rows = None, False, [], []

        def fresh() -> None:
            nonlocal turns, loss, counts, state, ok, error
            turns, loss, counts, state, ok, error = hashlib.sha256(), hashlib.sha256(), [0, 0, 0], template.start, True, None

        def take_turn() -> None:
            nonlocal error
            joined = "".join(parts)
            try:
                for role, text in template.read(joined):
                    turns.update(f"{role}\n{text}\n".encode())
                    counts[0] += 1
            except ValueError as e:
                error = error or str(e)
            counts[2] += len(joined)
            parts.clear()

        def row() -> tuple:
            return conv, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2], ok, state in template.ends, error

        turns = loss = counts = state = ok = error = None
        fresh()
        schema = None
        for batch in batches:
            schema = batch.schema
            names = {n: i for i, n in enumerate(batch.schema.names)}
            get = lambda n: batch.column(names[n]).to_pylist()  # noqa: B023, E731
            for c, k, s, fine, part, counted in zip(batch.column(0).to_pylist(), get("segment_no"), get("state"), get("in_order"), batch.column(names["text"]), get("loss")):
                if k == 0 and parts:
                    take_turn()
                if not began or c != conv:
                    if began:
                        rows.append(row())
                    fresh()
                    conv, began = c, True
                part = part.as_py() or ""
                parts.append(part)
                state, ok = s, ok and fine
                if counted:
                    plain = template.plain(part)
                    loss.update(plain.encode())
                    counts[1] += len(plain)
            if len(rows) >= BATCH_ROWS:
                yield packed(schema, rows)
                rows = []
        if began:
            take_turn()
            rows.append(row())
        if rows:
            yield packed(schema, rows)

    def packed(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
        kinds = [schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "in_order", "ended", "error"])

    return segments.mapInArrow(lean(run), f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, in_order boolean, ended boolean, error string")
