"""Repair of the turn structure of conversations by a run-length dynamic programme.

A sound conversation is empty or has an optional system turn and then pairs of a user and an assistant turn;
turns are known by the first letter of their role. Rows are blank (nothing but white space), duplicate (role
and text seen earlier in the conversation) or truncated (the last visible character ends no sentence); the
first of these counts. The cheapest edits make it sound: Keep (0), Rerole to user or assistant (2), Delete
(3, required for blank and duplicate rows), Insert an empty user or assistant turn anywhere (2); a truncated
row that is not deleted adds 1. Of equally cheap edits those win whose letters are least.

A row is a symbol (initial and fault), and a symbol a min-plus matrix over the four states of the role machine.
Equal symbols in a row are one run, through which costs advance by cached powers of 2 of its matrix; choices
are unrolled by the same powers. Matrices are associative, so a conversation is cut into pieces of at
most ``PIECE`` rows: each piece gives its matrix, pieces of a conversation meet as a few numbers each
(costs from behind, states from before), and rows are edited piece by piece. So a conversation of any length
is spread over tasks; only what is one value by contract, such as a digest, passes through one task.

Defined results: rows of a conversation are ordered by turn (nulls first), then role, then text (the first
``PREFIX`` characters, then a hash); null roles and texts are empty; null ids are one conversation; a role that
starts with no s, u or a cannot be kept; an empty table gives empty results; extra columns are ignored.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = 1 << 16  # rows of a conversation that one task holds, as symbols
PREFIX = 64  # characters of role and text in the order of rows of one turn

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua"  # others are one more class
DELETE, INSERT, KEEP, REROLE = 3, 2, 0, 2  # costs
CUT = 1  # of a truncated row that stays

#: States: nothing yet, after a system, a user and an assistant turn. A user turn comes next but in the third.
_NEXT = (2, 2, 3, 2)
_KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_ROLE = ("user", "user", "assistant", "user")
#: Costs from each state once no row is left: turns to insert.
END = (0, 4, 2, 0)
_INF = 1 << 40
Vector = tuple[int, int, int, int]


def _options(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a row in a state, by letter."""
    initial, fault = symbol & 3, symbol >> 2
    out = [("D", DELETE, state)]
    if fault in (SOUND, TRUNCATED):
        more = CUT if fault == TRUNCATED else 0
        kept = _KEPT[INITIALS[initial]] if initial < 3 else {}
        if state in kept:
            out.append(("K", KEEP + more, kept[state]))
        out.append(("R", REROLE + more, _NEXT[state]))
    return out


def _product(a: tuple[Vector, ...], b: tuple[Vector, ...]) -> tuple[Vector, ...]:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def _applied(a: tuple[Vector, ...], behind: Vector) -> Vector:
    return tuple(min(a[i][k] + behind[k] for k in range(4)) for i in range(4))


def _lowered(v: Vector) -> tuple[Vector, int]:
    """``v`` less its least value, and that value. Few different vectors are left."""
    low = min(v)
    return tuple(x - low if x < _INF else _INF for x in v), low


@dataclass
class Machine:
    """Caches of the powers of each symbol's matrix, of advanced costs and of unrolled choices."""

    powers: dict = field(default_factory=dict)
    advanced: dict = field(default_factory=dict)
    unrolled: dict = field(default_factory=dict)

    def power(self, symbol: int, k: int) -> tuple[Vector, ...]:
        """The matrix of 2 ** k rows of a symbol: costs from a state before them to a state behind them."""
        found = self.powers.get((symbol, k))
        if found is None:
            if k:
                half = self.power(symbol, k - 1)
                found = _product(half, half)
            else:
                cost = [[_INF] * 4 for _ in range(4)]
                for begin in range(4):
                    state = begin
                    for inserted in range(4):  # insertions before the row
                        for _, more, after in _options(symbol, state):
                            cost[begin][after] = min(cost[begin][after], INSERT * inserted + more)
                        state = _NEXT[state]
                found = tuple(map(tuple, cost))
            self.powers[symbol, k] = found
        return found

    def advance(self, symbol: int, n: int, behind: Vector) -> tuple[Vector, int]:
        """Costs before ``n`` rows of a symbol from lowered costs behind them: lowered, and by how much."""
        key = symbol, n, behind
        found = self.advanced.get(key)
        if found is None:
            v, low = behind, 0
            for k in range(n.bit_length()):
                if n >> k & 1:
                    v, by = _lowered(_applied(self.power(symbol, k), v))
                    low += by
            found = self.advanced[key] = v, low
            if len(self.advanced) > 1 << 16:
                self.advanced.clear()
        return found

    def unroll(self, symbol: int, n: int, state: int, behind: Vector) -> tuple[str, int]:
        """The least cheapest edits of ``n`` rows from a state, and the state behind them."""
        out = []
        while n:
            k = n.bit_length() - 1
            n -= 1 << k
            edits, state = self._block(symbol, k, state, self.advance(symbol, n, behind)[0])
            out.append(edits)
        return "".join(out), state

    def _block(self, symbol: int, k: int, state: int, behind: Vector) -> tuple[str, int]:
        key = symbol, k, state, behind
        found = self.unrolled.get(key)
        if found is None:
            if k:
                middle = _lowered(_applied(self.power(symbol, k - 1), behind))[0]
                first, state = self._block(symbol, k - 1, state, middle)
                second, state = self._block(symbol, k - 1, state, behind)
                found = first + second, state
            else:
                found = self._row(symbol, state, behind)
            self.unrolled[key] = found
            if len(self.unrolled) > 1 << 12:
                self.unrolled.clear()
        return found

    def _row(self, symbol: int, state: int, behind: Vector) -> tuple[str, int]:
        before, out = _applied(self.power(symbol, 0), behind), ""
        while True:
            choices = [(edit, after) for edit, cost, after in _options(symbol, state) if cost + behind[after] == before[state]]
            if choices and choices[0][0] == "D":
                return out + "D", choices[0][1]
            if INSERT + before[_NEXT[state]] == before[state]:
                out, state = out + "I", _NEXT[state]
            else:
                return out + choices[0][0], choices[0][1]


def runs_of(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and length of each run of equal symbols."""
    first = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1])) if len(symbols) else np.zeros(0, np.int64)
    return symbols[first], np.diff(np.append(first, len(symbols)))


def costs_before(machine: Machine, symbols: list[int], lengths: list[int], behind: Vector) -> list[tuple[Vector, int]]:
    """Lowered costs, and by how much in all, before each run and behind the last one."""
    v, low = _lowered(behind)
    out = [(v, low)]
    for symbol, n in zip(reversed(symbols), reversed(lengths)):
        v, by = machine.advance(symbol, n, v)
        low += by
        out.append((v, low))
    return out[::-1]


def edits_of(machine: Machine, symbols: list[int], lengths: list[int], state: int, behind: Vector) -> tuple[str, int]:
    """The edits of some runs from a state, given the costs behind them, and the state behind them."""
    costs, out = costs_before(machine, symbols, lengths, behind), []
    for symbol, n, (v, _) in zip(symbols, lengths, costs[1:]):
        edits, state = machine.unroll(symbol, n, state, v)
        out.append(edits)
    return "".join(out), state


def _print(*parts: Column) -> Column:
    """128 bits of some texts, each with its length before it; null is told from text."""
    marked = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.unhex(F.md5(F.concat(*marked).cast("binary")))


@dataclass(frozen=True)
class Repaired:
    """``edits``: rows (conv, conv_id, piece, seq, edit, role, text), in order of piece and seq within a
    conversation, a row for each edit: D has the deleted row, I, K and R have the rows that the repaired
    conversation consists of. ``conversations``: rows (conv, conv_id, gaps, blank, duplicate, truncated, illegal,
    cost). ``conv`` is a digest of the id."""

    edits: DataFrame
    conversations: DataFrame


def repair(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """Repair all conversations of ``rows``; ``turn`` is a number."""
    pieces = _pieces(rows, conv, turn, role, text)
    marked = _marked(pieces)
    summed = materialize(_summaries(marked), "repair-summaries")
    behind = materialize(_behind(summed), "repair-costs")
    unrolled = materialize(_unrolled(summed.join(behind.select("piece", "seg", "behind"), ["piece", "seg"])), "repair-choices")
    plan = _chosen(unrolled)

    turns = pieces.groupBy("conv").agg(
        F.first("conv_id", ignorenulls=True).alias("conv_id"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
    )
    faults = behind.groupBy("conv").agg(
        *(F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost"))
    )
    return Repaired(_edited(pieces, plan), turns.join(faults, "conv"))


def _pieces(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """All rows in order: (conv, conv_id, turn, role, text, print, symbol, piece, seg, at); ``at`` counts the rows
    of a piece, ``seg`` its conversations. ``symbol`` does not know of duplicates yet.

    Rows are dealt by ranges of the whole order, so that a long conversation is cut; copies of one row are
    told apart by a number that they get as they are read, which makes no difference to any result.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    seen = F.regexp_extract(text_, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(~text_.rlike(r"[^\x20\x09-\x0D]"), BLANK).when(seen.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    initial = F.substring(role_, 1, 1)
    initial = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    given = rows.select(
        _print(F.col(conv).cast("string")).alias("conv"),
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        role_.alias("role"),
        text_.alias("text"),
        _print(F.col(conv).cast("string"), role_, text_).alias("print"),
        (initial + 4 * fault).cast("int").alias("symbol"),
        F.monotonically_increasing_id().alias("copy"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), F.substring("role", 1, PREFIX), F.substring("text", 1, PREFIX), "print", "copy"]
    kept = ["conv", "conv_id", "turn", "role", "text", "print", "symbol"]
    schema = T.StructType(
        [given.schema[c] for c in kept]
        + [T.StructField("piece", T.LongType()), T.StructField("seg", T.IntegerType()), T.StructField("at", T.IntegerType())]
    )

    def number(parts):
        piece = TaskContext.get().partitionId() << 32
        at, seg, last = 0, -1, None
        for batch in parts:
            names: list[list[int]] = [[], [], []]
            for one in batch.column("conv").to_pylist():
                if at == PIECE:
                    piece, at, seg, last = piece + 1, 0, -1, None
                if one != last:
                    seg, last = seg + 1, one
                for name, value in zip(names, (piece, seg, at)):
                    name.append(value)
                at += 1
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(names[0], pa.int64()), pa.array(names[1], pa.int32()), pa.array(names[2], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    ranged = given.repartitionByRange(*order).sortWithinPartitions(*order).select(*kept)
    return materialize(ranged.mapInArrow(number, schema), "repair-rows")


def _marked(pieces: DataFrame) -> DataFrame:
    """Rows (conv, piece, seg, at, symbol) with later copies of a role and text as duplicates. The first place of
    each is a partial aggregate; only repeated ones are joined, in a form whose hot keys Spark can split."""
    place = F.struct("piece", "at")
    narrow = pieces.select("conv", "print", "piece", "seg", "at", "symbol")
    firsts = narrow.groupBy("print").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = firsts.select(F.col("print").alias("known"), "first")
    same = (F.col("print") == F.col("known")) & (F.xxhash64("print") == F.xxhash64("known"))
    copy = F.col("first").isNotNull() & (place != F.col("first")) & (F.shiftright("symbol", 2) != BLANK)
    symbol = F.when(copy, F.col("symbol").bitwiseAND(3) + 4 * DUPLICATE).otherwise(F.col("symbol")).cast("int")
    return narrow.join(repeated, same, "left").select("conv", "piece", "seg", "at", symbol.alias("symbol"))


_SUMMARY = (
    "conv binary, piece long, seg int, symbols binary, lengths binary, matrix binary, head int, tail int, "
    "blank long, duplicate long, truncated long, illegal long"
)


def _summaries(marked: DataFrame) -> DataFrame:
    """A row for each conversation in a piece: its runs, its matrix, what its ends are, its faults."""

    def run(parts):
        machine = Machine()

        def summary(conv: bytes, piece: int, seg: int, symbols: np.ndarray) -> tuple:
            kinds, lengths = runs_of(symbols)
            columns = []
            for end in range(4):  # the matrix, a column at a time
                v, low = costs_before(machine, kinds.tolist(), lengths.tolist(), tuple(0 if i == end else _INF for i in range(4)))[0]
                columns.append([min(x + low, _INF) for x in v])
            initial, fault = symbols & 3, symbols >> 2
            told = [int((fault == f).sum()) for f in (BLANK, DUPLICATE, TRUNCATED)]
            legal = np.array([a * 4 + b in (1, 6, 9) for a in range(4) for b in range(4)])  # su, ua, au
            illegal = int((~legal[initial[:-1] * 4 + initial[1:]]).sum())
            matrix = np.array(columns, "<i8").T.tobytes()
            return (conv, piece, seg, kinds.astype("u1").tobytes(), lengths.astype("<i4").tobytes(), matrix, int(initial[0]), int(initial[-1]), *told, illegal)

        for found in _by_segment(parts, lambda conv, piece, seg, symbols: summary(conv, piece, seg, symbols)):
            yield _batch(found, _SUMMARY)

    return marked.repartition("piece").sortWithinPartitions("piece", "at").mapInArrow(run, _SUMMARY)


def _by_segment(parts, make):
    """Lists of what ``make`` gives for the symbols of each conversation in each piece, from sorted rows."""
    held, symbols, out = None, [], []
    for batch in parts:
        if not batch.num_rows:
            continue
        piece, seg = (np.asarray(batch.column(c)).astype(np.int64) for c in ("piece", "seg"))
        symbol = np.asarray(batch.column("symbol")).astype(np.int64)
        first = np.flatnonzero(np.append(True, (piece[1:] != piece[:-1]) | (seg[1:] != seg[:-1])))
        for a, b in zip(first, np.append(first[1:], len(piece))):
            key = int(piece[a]), int(seg[a])
            if held is not None and held[1:] != key:
                out.append(make(*held, np.concatenate(symbols)))
                symbols = []
            if held is None or held[1:] != key:
                held = (batch.column("conv")[int(a)].as_py(), *key)
            symbols.append(symbol[a:b])
        yield out
        out = []
    if held is not None:
        yield [make(*held, np.concatenate(symbols))]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    names = [c.split() for c in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, names)], names=[n for n, _ in names])


def _by_conversation(rows: DataFrame, take, schema: str) -> DataFrame:
    """``take`` gets the rows of each conversation in order of its pieces, as dictionaries."""

    def run(parts):
        held: list[dict] = []
        for batch in parts:
            out = []
            for row in batch.to_pylist():
                if held and held[-1]["conv"] != row["conv"]:
                    out += take(held)
                    held = []
                held.append(row)
            yield _batch(out, schema)
        if held:
            yield _batch(take(held), schema)

    return rows.repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(run, schema)


def _behind(summed: DataFrame) -> DataFrame:
    """The costs behind each piece of a conversation, from its later pieces. Faults are carried along; the cost of
    all is in the first piece."""

    def take(pieces: list[dict]) -> list[tuple]:
        v, low, out, after = END, 0, [], None
        for p in reversed(pieces):
            behind = np.array(v, "<i8").tobytes()
            m = np.frombuffer(p["matrix"], "<i8").reshape(4, 4)
            v, by = _lowered(_applied(tuple(map(tuple, m.tolist())), v))
            low += by
            joint = after is not None and p["tail"] * 4 + after not in (1, 6, 9)
            after = p["head"]
            first = p is pieces[0]
            out.append((p["conv"], p["piece"], p["seg"], behind, p["blank"], p["duplicate"], p["truncated"], p["illegal"] + joint, v[0] + low if first else 0))
        return out

    columns = summed.select("conv", "piece", "seg", "matrix", "head", "tail", "blank", "duplicate", "truncated", "illegal")
    schema = "conv binary, piece long, seg int, behind binary, blank long, duplicate long, truncated long, illegal long, cost long"
    return _by_conversation(columns, take, schema)


_UNROLLED = "conv binary, piece long, seg int, " + ", ".join(f"edits{s} binary, end{s} int" for s in range(4))


def _unrolled(given: DataFrame) -> DataFrame:
    """The edits of each conversation's part of a piece from each of the four states."""

    def run(parts):
        machine = Machine()
        for batch in parts:
            out = []
            for p in batch.to_pylist():
                symbols, lengths = list(p["symbols"]), np.frombuffer(p["lengths"], "<i4").tolist()
                behind = tuple(np.frombuffer(p["behind"], "<i8").tolist())
                each = [edits_of(machine, symbols, lengths, s, behind) for s in range(4)]
                out.append((p["conv"], p["piece"], p["seg"], *(x for edits, end in each for x in (edits.encode(), end))))
            yield _batch(out, _UNROLLED)

    return given.select("conv", "piece", "seg", "symbols", "lengths", "behind").mapInArrow(run, _UNROLLED)


def _chosen(unrolled: DataFrame) -> DataFrame:
    """Rows (piece, seg, state, edits): the state in which each part begins, and its edits. The last part of a
    conversation ends with the insertions that complete it."""

    def take(pieces: list[dict]) -> list[tuple]:
        state, out = 0, []
        for p in pieces:
            begun, state = state, p[f"end{state}"]
            out.append((p["piece"], p["seg"], begun, END[state] // INSERT if p is pieces[-1] else 0))
        return out

    states = _by_conversation(
        unrolled.select("conv", "piece", "seg", *(f"end{s}" for s in range(4))), take, "piece long, seg int, state int, more int"
    )
    edits = F.coalesce(*(F.when(F.col("state") == s, F.col(f"edits{s}").cast("string")) for s in range(4)))
    edits = F.concat(edits, F.repeat(F.lit("I"), F.col("more")))
    return unrolled.join(states, ["piece", "seg"]).select("piece", "seg", "state", edits.alias("edits"))


def _edited(pieces: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows with their edits; each part's edits come before its rows in the sorted stream."""
    schema = T.StructType(
        [pieces.schema["conv"], pieces.schema["conv_id"]]
        + [T.StructField(n, k) for n, k in (("piece", T.LongType()), ("seq", T.LongType()), ("edit", T.StringType()), ("role", T.StringType()), ("text", T.StringType()))]
    )

    def run(parts):
        letters, taken, state = "", 0, 0
        for batch in parts:
            source, seq, edit, role, text = [], [], [], [], []

            def emit(row: int, one: str, role_: str | None, text_: str | None) -> None:
                for column, value in zip((source, seq, edit, role, text), (row, taken, one, role_, text_)):
                    column.append(value)

            columns = {c: batch.column(c).to_pylist() for c in ("at", "role", "text", "edits", "state")}
            for i in range(batch.num_rows):
                if columns["at"][i] < 0:
                    letters, taken, state = columns["edits"][i], 0, columns["state"][i]
                    continue
                while True:
                    one = letters[taken]
                    if one == "I":
                        emit(i, one, _ROLE[state], "")
                        state = _NEXT[state]
                    elif one == "D":
                        emit(i, one, columns["role"][i], columns["text"][i])
                    elif one == "R":
                        emit(i, one, _ROLE[state], columns["text"][i])
                        state = _NEXT[state]
                    else:
                        emit(i, one, columns["role"][i], columns["text"][i])
                        state = _KEPT[columns["role"][i][0]][state]
                    taken += 1
                    if one != "I":
                        break
                if letters.find("I", taken) == taken and letters.count("I", taken) == len(letters) - taken:
                    while taken < len(letters):  # the insertions behind the last row
                        emit(i, "I", _ROLE[state], "")
                        state, taken = _NEXT[state], taken + 1
            rows = pa.array(source, pa.int64())
            given = [batch.column(c).take(rows) for c in ("conv", "conv_id", "piece")]
            made = [pa.array(seq, pa.int64()), pa.array(edit, pa.string()), pa.array(role, pa.string()), pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(given + made, names=[f.name for f in schema.fields])

    names = ["conv", "conv_id", "piece", "seg", "at", "role", "text", "edits", "state"]
    heads = plan.withColumn("at", F.lit(-1))
    both = pieces.select(*names[:7]).unionByName(heads, allowMissingColumns=True).select(*names)
    return both.repartition("piece").sortWithinPartitions("piece", "seg", "at").mapInArrow(run, schema)


def digests(edits: DataFrame) -> DataFrame:
    """Rows (conv, audit, repaired_sha256): the letters of all edits of a conversation, and the digest of its
    repaired turns as ``role:text``, with a new line between them. A digest goes over a conversation's bytes
    in order, so each conversation passes through one task, in the memory of a batch and its letters."""
    schema = "conv binary, audit string, repaired_sha256 string"

    def run(parts):
        import hashlib

        conv, letters, digest, begun = None, [], hashlib.sha256(), False
        for batch in parts:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv", "edit", "role", "text"))
            for one, edit, role, text in zip(*columns):
                if one != conv:
                    if conv is not None:
                        out.append((conv, "".join(letters), digest.hexdigest()))
                    conv, letters, digest, begun = one, [], hashlib.sha256(), False
                letters.append(edit)
                if edit != "D":
                    digest.update((("\n" if begun else "") + role + ":" + text).encode())
                    begun = True
            yield _batch(out, schema)
        if conv is not None:
            yield _batch([(conv, "".join(letters), digest.hexdigest())], schema)

    narrow = edits.select("conv", "piece", "seq", "edit", F.when(F.col("edit") != "D", F.col("role")).alias("role"), F.when(F.col("edit") != "D", F.col("text")).alias("text"))
    return narrow.repartition("conv").sortWithinPartitions("conv", "piece", "seq").mapInArrow(run, schema)
