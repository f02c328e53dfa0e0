"""Format conversations as text segments with loss flags, and read them back.

A template declares the markers of each role, whether its text carries loss, and which role may follow
which: a finite-state machine whose state is the role of the last turn. Conversations are dealt by
their id and sorted by turn within a task; both directions stream over the sorted rows with one
machine state, so a conversation of any length needs the memory of one turn.

Markers that occur inside a text get a backslash after their first character, and each backslash of a
text is doubled. A single backslash is thus never a text's own, so the escape is exactly reversible and no
text can open or close a turn.

Defined results: conversation ids are of any type and come back as they are; a null text or role is empty; a role that the template does not name is kept, in
markers of its own, and is an error of order; a null conversation id is a conversation; rows with one
turn number are ordered by role and text; a conversation out of order is formatted like any other and
reported as ``invalid``, one whose last turn needs an answer as ``open``; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(batches)

SEGMENT = "turn_no long, part string, text string, loss boolean, status string"


@dataclass(frozen=True)
class Role:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``follows``: the roles that may come after each role ("" is the start); ``ends``: the roles
    that may come last. ``other`` marks a role that is not named: open, end of its name, close."""

    begin: str
    roles: dict[str, Role]
    follows: dict[str, tuple[str, ...]]
    ends: tuple[str, ...]
    other: tuple[str, str, str]
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        every = {self.begin, *self.other, *(m for r in self.roles.values() for m in (r.open, r.close))}
        for a in every:
            if len(a) < 2 or "\\" in a:
                raise ValueError(f"a marker needs two characters and no backslash: {a!r}")
            for b in every:
                if any(a.endswith(b[:n]) for n in range(1, len(b))) or a != b and b in a:
                    raise ValueError(f"markers may not overlap: {a!r}, {b!r}")
        object.__setattr__(self, "controls", tuple(sorted(every)))

    def escape(self, text: str) -> str:
        text = text.replace("\\", "\\\\")
        for marker in self.controls:
            text = text.replace(marker, f"{marker[0]}\\{marker[1:]}")
        return text

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def turn(self, role: str, text: str) -> list[tuple[str, str, bool]]:
        """The segments of a turn: part, text and whether it carries loss."""
        if role in self.roles:
            marks = self.roles[role]
            opened, close, loss = marks.open, marks.close, marks.loss
        else:
            opened, close, loss = f"{self.other[0]}{self.escape(role)}{self.other[1]}", self.other[2], False
        return [("open", opened, False), ("text", self.escape(text), loss), ("close", close, False)]


# The markers of the template.
INSTRUCT = Template(
    begin="<s>",
    roles={
        "system": Role("<<SYS>>", "<</SYS>>"),
        "user": Role("[INST]", "[/INST]"),
        "assistant": Role("[ANSWER]", "</s>", loss=True),
    },
    follows={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("assistant",),
    other=("[ROLE]", "[SAYS]", "[/ROLE]"),
)


class Machine:
    """The state of one conversation: the last role, and whether every turn was in order."""

    def __init__(self, template: Template) -> None:
        self.template, self.state, self.valid = template, "", True

    def step(self, role: str) -> None:
        self.valid &= role in self.template.follows.get(self.state, ())
        self.state = role if role in self.template.roles else ""

    @property
    def status(self) -> str:
        return "invalid" if not self.valid else "complete" if self.state in self.template.ends else "open"


def segments(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Rows (conv_id, turn_no, part, text, loss, status), in order within each partition; each
    conversation is in one partition. Its last row, of part ``end``, has no text but the status."""

    def run(parts):
        conv, machine, turn_no, out, id_type = None, None, 0, [], None

        def packed():
            columns = list(zip(*out)) if out else [()] * 6
            types = (id_type, pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string())
            names = ("conv_id", "turn_no", "part", "text", "loss", "status")
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))

        for batch in (part for given in parts for part in batches.slices(given, "text")):
            held, id_type = 0, batch.schema.field("conv_id").type
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                role, text = role or "", text or ""
                if machine is None or c != conv:
                    if machine is not None:
                        out.append((conv, turn_no, "end", "", False, machine.status))
                    conv, machine, turn_no = c, Machine(template), 0
                    out.append((conv, -1, "begin", template.begin, False, None))
                machine.step(role)
                out += [(conv, turn_no, *segment, None) for segment in template.turn(role, text)]
                turn_no += 1
                held += len(text)
                if held > 4 << 20:
                    yield packed()
                    out, held = [], 0
            yield packed()
            out = []
        if machine is not None:
            out.append((conv, turn_no, "end", "", False, machine.status))
            yield packed()

    rows = conversations.select("conv_id", "turn", "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), *T.StructType.fromDDL(SEGMENT)])
    return ordered.select("conv_id", "role", "text").mapInArrow(run, schema)


class Reader:
    """Take formatted text piece by piece and give back its turns."""

    def __init__(self, template: Template) -> None:
        self.template, self.buffer, self.role, self.begun = template, "", None, False
        self.opens = {r.open: name for name, r in template.roles.items()}

    def feed(self, piece: str) -> list[tuple[str, str]]:
        self.buffer += piece
        found = []
        while True:
            if not self.begun:
                if not self.buffer.startswith(self.template.begin):
                    return found
                self.buffer, self.begun = self.buffer[len(self.template.begin) :], True
            if self.role is None and not self._open():
                return found
            close = self.template.roles[self.role].close if self.role in self.template.roles else self.template.other[2]
            at = self.buffer.find(close)
            if at < 0:
                return found
            found.append((self.role, self.template.unescape(self.buffer[:at])))
            self.buffer, self.role = self.buffer[at + len(close) :], None

    def _open(self) -> bool:
        for marker, name in self.opens.items():
            if self.buffer.startswith(marker):
                self.buffer, self.role = self.buffer[len(marker) :], name
                return True
        start, says, _ = self.template.other
        if self.buffer.startswith(start) and says in self.buffer:
            at = self.buffer.index(says)
            self.role = self.template.unescape(self.buffer[len(start) : at])
            self.buffer = self.buffer[at + len(says) :]
            return True
        return False


def read_back(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation, from the result of :func:`segments`: the turns that a reader finds in the
    concatenated text, as a digest, and the text under the loss mask."""
    found_in = T.StructType.fromDDL(
        "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, status string"
    )
    schema = T.StructType([T.StructField("conv_id", formatted.schema["conv_id"].dataType), *found_in])

    def run(parts):
        import hashlib

        reader = None
        for batch in parts:
            out = []
            for conv, part, text, loss, status in zip(
                *(batch.column(n).to_pylist() for n in ("conv_id", "part", "text", "loss", "status"))
            ):
                if part == "begin":
                    reader, turns, n_turns, n_chars = Reader(template), hashlib.sha256(), 0, 0
                    under, loss_chars = hashlib.sha256(), 0
                n_chars += len(text)
                if loss:
                    plain = template.unescape(text)
                    under.update(plain.encode())
                    loss_chars += len(plain)
                for role, said in reader.feed(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n_turns += 1
                if part == "end":
                    out.append((conv, n_turns, turns.hexdigest(), loss_chars, under.hexdigest(), n_chars, status))
            columns = list(zip(*out)) if out else [()] * 7
            id_type = batch.schema.field("conv_id").type
            kinds = (id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=schema.names)

    return formatted.mapInArrow(run, schema)
