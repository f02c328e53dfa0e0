"""Histories with chains and late updates against a plain timeline; stored logs with snapshots."""

import datetime
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import plan, rows
from tidemark.operators import versions
from tidemark.operators.merge import AmbiguousMergeError
from tidemark.operators.scd2_history import apply_history, merge_history

DIM = "k int, name string, v string, effective_date int, end_date int, is_current boolean"
UPD = "k int, name string, v string, effective_date int"
FORMS = [apply_history, merge_history]


def plain(dimension, updates):
    """Apply updates one by one in order of time to the versions of their key."""
    out = [list(r) for r in dimension]
    for k, name, v, start in sorted(set(updates), key=lambda u: (u[0] is not None, u[0] or 0, u[3])):
        mine = [r for r in out if k is not None and r[0] == k]
        holder = next((r for r in mine if r[3] <= start and (r[4] is None or r[4] > start)), None)
        if holder is not None:
            if holder[2] == v:
                continue
            end, holder[4], holder[5] = holder[4], start, False
        else:
            end = min((r[3] for r in mine if r[3] > start), default=None)
        out.append([k, name, v, start, end, end is None])
    return sorted(map(tuple, out), key=str)


def history(draw, keys):
    """Versions of each key, some with gaps and some closed; updates anywhere, also at a version's start."""
    dimension, updates = [], []
    for k in range(keys):
        moment = draw.randint(0, 20)
        for _ in range(draw.randint(0, 4)):
            end = moment + draw.randint(1, 20)
            dimension.append((k, f"n{k}", draw.choice("abc"), moment, end, False))
            moment = end + draw.choice([0, 0, 0, 7])
        if dimension and dimension[-1][0] == k and draw.random() < 0.7:
            dimension[-1] = (*dimension[-1][:4], None, True)
        starts = draw.sample(range(90), draw.randint(0, 6))
        updates += [(k, f"u{s}", draw.choice(["a", "b", "c", None]), s) for s in starts]
    return dimension, updates + updates[:3] + [(None, "no key", "a", 5)]


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("seed, limit", [(1, 1 << 26), (2, 0)])
def test_against_updates_one_by_one(spark, form, seed, limit):
    dimension, updates = history(random.Random(seed), 150)
    extra = spark.createDataFrame(dimension, DIM).selectExpr("*", "v AS `update`", "k AS `_key`", "1 AS holder", "2 AS merge_key")
    got = form(extra, spark.createDataFrame(updates, UPD), "k", ["v"], broadcast_bytes=limit)
    found = sorted((tuple(r)[:6] for r in got.collect()), key=str)
    assert found == plain(dimension, updates)
    per_key = {}
    for r in found:
        per_key.setdefault(r[0], []).append((r[3], r[4] if r[4] is not None else 10**9))
    for k, periods in per_key.items():
        periods.sort()
        assert k is None or all(a[1] <= b[0] for a, b in zip(periods, periods[1:]))


@pytest.mark.parametrize("form", FORMS)
def test_two_updates_at_one_moment_and_none_are_errors(spark, form):
    dimension = spark.createDataFrame([(1, "n", "a", 0, None, True)], DIM)
    with pytest.raises(AmbiguousMergeError):
        form(dimension, spark.createDataFrame([(1, "n", "b", 5), (1, "n", "c", 5)], UPD), "k", ["v"])
    with pytest.raises(PySparkException, match="no start"):
        form(dimension, spark.createDataFrame([(1, "n", "b", None)], UPD), "k", ["v"]).collect()


@pytest.mark.parametrize("form", FORMS)
def test_empty_sides(spark, form):
    dimension, none = spark.createDataFrame([(1, "n", "a", 0, None, True)], DIM), spark.createDataFrame([], UPD)
    assert rows(form(dimension, none, "k", ["v"])) == rows(dimension)
    fresh = form(dimension.limit(0), spark.createDataFrame([(2, "n", "b", 3), (2, "n", "c", 4)], UPD), "k", ["v"])
    assert rows(fresh) == [(2, "n", "b", 3, 4, False), (2, "n", "c", 4, None, True)]


def test_only_versions_of_updated_keys_are_sorted(spark, tmp_path):
    spark.range(0, 5000, 1, 4).selectExpr(
        "cast(id AS int) AS k", "'n' AS name", "'a' AS v", "0 AS effective_date", "cast(NULL AS int) AS end_date", "true AS is_current"
    ).write.parquet(f"{tmp_path}/dim")
    dimension = spark.read.parquet(f"{tmp_path}/dim")
    got = apply_history(dimension, spark.createDataFrame([(7, "n", "b", 3), (7, "n", "c", 4)], UPD), "k", ["v"])
    assert "Sort" not in plan(got) and "BroadcastHashJoin" in plan(got)
    assert got.count() == 5002 and got.where("is_current").count() == 5000


# --- stored logs -----------------------------------------------------------------------------

AT = [datetime.datetime(2022, 1, d) for d in range(1, 9)]


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """Eight commits, snapshots after the third and the sixth; a null key; states by version."""
    root, draw = str(tmp_path_factory.mktemp("log")), random.Random(4)
    state, states = {}, []
    for version, at in enumerate(AT):
        changes = []
        for k in [*draw.sample(range(30), 12), None]:
            operation = "delete" if k in state and draw.random() < 0.4 else "update" if k in state else "insert"
            changes.append((k, f"{k}-{version}", f"g{version}", operation))
            state.pop(k, None) if operation == "delete" else state.update({k: (k, f"{k}-{version}", f"g{version}")})
        df = spark.createDataFrame(changes, "k int, v string, _gone string, _op string")
        versions.append_commit(df, root, version, at)
        if version in (2, 5):
            versions.write_snapshot(spark, root, ["k"], version)
        states.append(sorted(state.values(), key=lambda r: tuple((x is None, str(x)) for x in r)))
    return root, states


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_every_version_and_moment(spark, log, limit):
    root, states = log
    for version, expected in enumerate(states):
        assert rows(versions.state_at(spark, root, ["k"], version, broadcast_bytes=limit)) == expected
        moment = AT[version] + datetime.timedelta(hours=3)
        assert rows(versions.state_at(spark, root, ["k"], timestamp=moment, broadcast_bytes=limit)) == expected
    assert rows(versions.state_at(spark, root, ["k"])) == states[-1]


def test_other_versions_are_pruned(spark, log):
    read = versions.state_at(spark, log[0], ["k"], 7)._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in read.splitlines() if "PartitionFilters" in line]
    assert any("(_version#" in f and "> 5)" in f and "<= 7)" in f for f in filters)
    assert any("= 5)" in f for f in filters)


def test_moments_with_a_zone(spark, log):
    root, states = log
    zone = datetime.timezone(datetime.timedelta(hours=5))
    assert rows(versions.state_at(spark, root, ["k"], timestamp=datetime.datetime(2022, 1, 3, 4, 59, tzinfo=zone))) == states[1]
    assert rows(versions.state_at(spark, root, ["k"], timestamp=datetime.datetime(2022, 1, 3, 5, tzinfo=zone))) == states[2]
    changes = versions.commit(spark.createDataFrame([(1, "a")], "k int, v string"), 0, datetime.datetime(2022, 1, 1, 15, tzinfo=zone), "insert")
    assert versions.as_of(changes, ["k"], timestamp=datetime.datetime(2022, 1, 1, 10)).count() == 1
    with pytest.raises(ValueError):
        versions.as_of(changes, ["k"], timestamp=datetime.datetime(2022, 1, 1, 14, tzinfo=zone))


def test_before_the_first_commit_and_without_snapshots(spark, log, tmp_path):
    root, _ = log
    for point in ({"version": -1}, {"timestamp": AT[0] - datetime.timedelta(seconds=1)}):
        with pytest.raises(ValueError, match="no commit"):
            versions.state_at(spark, root, ["k"], **point)
    with pytest.raises(ValueError, match="no commit"):
        versions.state_at(spark, f"{tmp_path}/nothing", ["k"])
    plain_root = f"{tmp_path}/plain"
    versions.append_commit(spark.createDataFrame([(1, "a")], "k int, v string"), plain_root, 0, AT[0], "insert")
    versions.append_commit(spark.createDataFrame([(1, "b")], "k int, v string"), plain_root, 1, AT[1], "update")
    assert rows(versions.state_at(spark, plain_root, ["k"])) == [(1, "b")]
    assert F is not None
