"""Queries with SQL give the rows of their SQL; all queries cope with awkward and empty tables."""

import os
import subprocess
import sys

import duckdb
import pytest

import brute
from conftest import rows
from tidemark.llm import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("name", list(SQL))
def test_same_rows_as_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "conversations", "benchmark", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(SQL[name])
    columns = sorted(result.columns)
    assert sorted(expected.columns) == columns
    in_order = lambda found: sorted((tuple(r) for r in found), key=lambda r: tuple((v is None, str(v)) for v in r))
    theirs = expected.select(*(f'"{c}"' for c in columns)).fetchall()
    assert in_order(result.select(columns).collect()) == in_order(theirs)


@pytest.fixture(scope="module", params=["awkward", "empty"])
def tables(request, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp(request.param))
    docs = getattr(brute, request.param)(spark)
    docs.write.parquet(f"{path}/documents.parquet")
    docs.selectExpr("doc_id", "CAST(1 AS INT) AS quality", "CAST(NULL AS INT) AS toxic").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, None), (2, ""), (None, "x")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    turns = [(1, None, None, None), (1, 2, "tool", "a [ROLE] \\ </s>"), (None, 1, "user", "<s>"), (2, 1, "assistant", ""), (2, 1, "assistant", "")]
    turns = spark.createDataFrame(turns if request.param == "awkward" else [], "conv_id long, turn long, role string, text string")
    turns.write.parquet(f"{path}/conversations.parquet")
    return path, docs.count()


@pytest.mark.parametrize("name", list(QUERIES))
def test_awkward_and_empty_tables(spark, tables, name):
    path, n = tables
    found = QUERIES[name](spark, path).collect()
    if name.startswith("op3_"):
        assert -1 in [r["conv_id"] for r in found]
    elif name.startswith("op2_"):
        assert found == []
    elif name.startswith("op12_"):
        assert all(r["value"] == 0 and r["part"] == "pair" for r in found)  # no term is in 30 documents
    elif name.startswith("op13_"):
        assert len(found) == (3 if n else 0)
    else:
        assert len(found) == n


def test_entry_works_without_these_operators(tmp_path):
    code = (
        "import sys; sys.modules['tidemark.llm'] = None; sys.modules['corpus_pipeline'] = None; "
        "import __spark_entry__ as e; assert set(e.queries()) == set(e.oracle_sql()); assert len(e.queries()) > 90"
    )
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)


def test_entry_has_all_queries():
    sys.path.insert(0, REPO)
    import __spark_entry__ as entry

    numbers = {int(n[2:].split("_")[0]) for n in entry.queries() if n[:2] == "op" and n[2].isdigit()}
    assert numbers == set(range(1, 14)) and "pipeline" in entry.queries()
    assert rows is not None
