import hashlib

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm import QUERIES, chat
from tidemark.llm.op3 import PROBE_TEXT, SQL

T = chat.INSTRUCT
SAID = st.lists(st.sampled_from([*T.controls, "\\", "<", "s>", "[", "/", "INST]", "é", "x", "\n"]), max_size=12).map("".join)


@given(st.lists(st.tuples(st.one_of(st.sampled_from([*T.roles]), SAID), SAID), max_size=6))
def test_round_trip(turns):
    """Whatever is said, in whatever pieces it arrives, the same turns come back."""
    formatted = T.begin + "".join(text for role, said in turns for _, text, _ in T.turn(role, said))
    for step in (1, 7, 10_000):
        reader, found = chat.Reader(T), []
        for i in range(0, len(formatted), step):
            found += reader.feed(formatted[i : i + step])
        assert found == turns and not reader.buffer
    for _, said in turns:
        assert not any(marker in T.escape(said) for marker in T.controls)


def test_templates_whose_markers_overlap_are_refused():
    with pytest.raises(ValueError):
        chat.Template("<s>", {"user": chat.Role("<u>", "><")}, {}, (), ("[R]", "[S]", "[E]"))


def test_loss_and_order(spark):
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello </s>"), (1, 3, "user", "?"),
        (2, 0, "user", "a"), (2, 1, "user", "b"), (2, 2, "assistant", "c"),
        (3, 0, "user", "a"), (3, 1, "assistant", "b\\"), (3, 2, "tool", "z"),
        (4, 0, "user", "a"), (4, 1, "assistant", None),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(5)
    found = {r["conv_id"]: r for r in chat.read_back(chat.segments(df)).collect()}
    assert {k: r["status"] for k, r in found.items()} == {1: "open", 2: "invalid", 3: "invalid", 4: "complete"}
    assert found[1]["loss_chars"] == len("hello </s>")
    assert found[1]["loss_sha256"] == hashlib.sha256(b"hello </s>").hexdigest()
    assert found[3]["turns_sha256"] == hashlib.sha256(b"user\na\nassistant\nb\\\ntool\nz\n").hexdigest()
    flags = {(r["part"], r["loss"]) for r in chat.segments(df).where("turn_no = 2 AND conv_id = 1").collect()}
    assert flags == {("open", False), ("text", True), ("close", False)}


def test_a_conversation_that_holds_a_third_of_all_turns(spark):
    df = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text"
    )
    found = chat.read_back(chat.segments(df)).where("conv_id = 0").first()
    expected = "".join(f"{'assistant' if i % 2 else 'user'}\nt{i}\n" for i in range(0, 30_000, 3))
    assert found["n_turns"] == 10_000
    assert found["turns_sha256"] == hashlib.sha256(expected.encode()).hexdigest()


@pytest.mark.parametrize("kind, one, two", [("string", "'a'", "'b'"), ("int", "1", "2"), ("date", "DATE'2024-01-01'", "DATE'2024-01-02'")])
def test_ids_of_any_type(spark, kind, one, two):
    df = spark.sql(f"SELECT * FROM VALUES ({one}, 0L, 'user', 'x'), ({two}, 0L, 'user', 'y'), (NULL, 0L, 'user', 'z') AS t(conv_id, turn, role, text)")
    found = chat.read_back(chat.segments(df))
    assert found.schema["conv_id"].dataType.simpleString() == kind
    said = {r["turns_sha256"]: r["conv_id"] for r in found.collect()}
    ids = {r["text"]: r["conv_id"] for r in df.collect()}
    assert said == {hashlib.sha256(f"user\n{t}\n".encode()).hexdigest(): i for t, i in ids.items()}


def test_the_probe_is_no_conversation_of_the_table(spark, tmp_path):
    """Conversation -1 of the table comes back beside the one made of control strings."""
    rows = [(-1, 0, "user", "a"), (-1, 1, "assistant", "b"), (5, 0, "user", "c")]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(path)
    found = [(r["conv_id"], r["n_turns"], r["loss_chars"], r["status"]) for r in QUERIES["op3_format_chats"](spark, str(tmp_path)).collect()]
    assert sorted(found) == [(-1, 2, 1, "complete"), (-1, 2, len(PROBE_TEXT), "complete"), (5, 1, 0, "open")]
    sql = duckdb.sql(SQL.replace("FROM conversations", f"FROM '{path}/*.parquet'"))
    kept = sql.project("conv_id, n_turns, loss_chars, status").fetchall()
    assert sorted(kept) == sorted(found)
