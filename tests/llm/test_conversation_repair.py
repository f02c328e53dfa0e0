import hashlib
import itertools
import random
import re
import zlib

import pytest

from tidemark.llm import conversation_repair as cr
from tidemark.llm import op13

SF_DIR = "/root/testdata/sf0.01"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        visible = VISIBLE.findall(text)
        if not visible:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("sound" if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Plain dynamic programme over rows: least (cost, letters, turns) in each state from the front."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, "", ())}

    def inserted(best):
        while True:
            more = dict(best)
            for state, (cost, letters, turns) in best.items():
                for role in ("user", "assistant"):
                    if role[0] in after[state]:
                        new = (cost + 2, letters + "I", (*turns, (role, "")))
                        if role[0] not in more or new[:2] < more[role[0]][:2]:
                            more[role[0]] = new
            if more == best:
                return best
            best = more

    for (role, text), fault in zip(rows, faults):
        new = {}

        def offer(state, way):
            if state not in new or way[:2] < new[state][:2]:
                new[state] = way

        for state, (cost, letters, turns) in inserted(best).items():
            offer(state, (cost + 3, letters + "D", turns))
            if fault in ("sound", "truncated"):
                cut = fault == "truncated"
                if role[:1] in after[state]:
                    offer(role[0], (cost + cut, letters + "K", (*turns, (role, text))))
                for other in ("user", "assistant"):
                    if other[0] in after[state]:
                        offer(other[0], (cost + 2 + cut, letters + "R", (*turns, (other, text))))
        best = new
    return min((way for state, way in inserted(best).items() if state in ("", "a")), key=lambda w: w[:2])


def plain(rows):
    """All columns of op13 by conversation, from rows before the damage."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = [r[1] for r in mine if r[1] is not None]
        said = [(r[2], r[3]) for r in mine]
        faults = faults_of(said)
        cost, audit, repaired = cheapest(said, faults)
        pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(said)]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
        )
    return out


def found(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def conversations(seed, n, turns):
    draw, out = random.Random(seed), []
    texts = ["Yes.", "No", "", " \n", "Why?", "a b", "So!", "x.", None]
    for conv in range(n):
        for turn in range(draw.randint(1, turns)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "unit", None])
            out.append((conv, draw.choice([turn, turn, turn + 2, None]), role, draw.choice(texts) if draw.random() < 0.7 else f"text {draw.random()}."))
    return out


@pytest.mark.parametrize("turns", [1, 4, 30])
def test_machine_against_plain_programme(turns):
    draw, machine = random.Random(turns), cr.Machine()
    names = ["sound", "blank", "duplicate", "truncated"]
    for _ in range(300):
        symbols = [s for _ in range(draw.randint(0, turns)) for s in [draw.choice([0, 1, 2, 1, 2, 3]) + 4 * draw.choice([0, 0, 0, 1, 2, 3])] * draw.choice([1, 1, 1, 2, 9])]
        kinds, lengths = (x.tolist() for x in cr.runs_of(cr.np.array(symbols, dtype=int)))
        rows = [("suat"[s & 3], "x") for s in symbols]
        expected = cheapest(rows, [names[s >> 2] for s in symbols])
        v, low = cr.costs_before(machine, kinds, lengths, cr.END)[0]
        assert v[0] + low == expected[0]
        edits, state = cr.edits_of(machine, kinds, lengths, 0, cr.END)
        assert edits + "I" * (cr.END[state] // 2) == expected[1]


def test_long_runs():
    machine = cr.Machine()
    edits, state = cr.edits_of(machine, [1 + 4 * cr.BLANK], [1_000_003], 0, cr.END)
    assert (edits, state) == ("D" * 1_000_003, 0)
    (v, low) = cr.costs_before(machine, [1], [100_001], cr.END)[0]
    assert v[0] + low == cheapest([("u", "x")] * 101, ["sound"] * 101)[0] + 99_900


@pytest.mark.parametrize("piece, seed", [(1 << 16, 1), (3, 2), (1, 3)])
def test_query_against_plain_programme(spark, tmp_path, monkeypatch, piece, seed):
    """Also with conversations cut into pieces of one and three rows."""
    monkeypatch.setattr(cr, "PIECE", piece)
    rows = conversations(seed, 60, 25) + [(99, 0, "user", "Same."), (None, 1, "user", "Hm."), (None, None, None, None)] + [(99, 0, "user", "Same.")] * 40
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.selectExpr("*", "1 AS piece", "2 AS conv", "3 AS seg", "4 AS symbol").repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    assert found(op13.op13_repair_conversations(spark, str(tmp_path))) == plain(rows)


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op13.op13_repair_conversations(spark, SF_DIR)) == plain(rows)


def test_edits_are_rows(spark):
    """The operator's own output: repaired turns with their texts; text ids; long texts."""
    rows = [("a", 1, "user", "Hi?"), ("a", 2, "user", "long " * 50_000), ("b", 1, "assistant", "Yes.")]
    result = cr.repair(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))
    kept = sorted((r["conv_id"], r["piece"], r["seq"], r["edit"], r["role"], len(r["text"])) for r in result.edits.collect())
    assert [(c, e, r, n) for c, _, _, e, r, n in kept] == [("a", "K", "user", 3), ("a", "R", "assistant", 250_000), ("b", "I", "user", 0), ("b", "K", "assistant", 4)]
    assert {r["conv_id"]: r["cost"] for r in result.conversations.collect()} == {"a": 3, "b": 2}


def test_empty_table(spark):
    result = cr.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert result.edits.isEmpty() and result.conversations.isEmpty() and cr.digests(result.edits).isEmpty()
