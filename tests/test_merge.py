import random

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tidemark.operators.merge import AmbiguousMergeError, WhenMatched, WhenNotMatched, merge, merge_metrics

KV = "k long, v string"


def upsert(target, source, on="k", **options):
    return merge(target, source, on, [WhenMatched()], [WhenNotMatched()], **options)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (3, "c"), (3, "c2")], KV)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_upsert_keeps_updates_inserts(spark, target, limit):
    source = spark.createDataFrame([(2, "B"), (3, "C"), (9, "new"), (None, "m")], KV)
    merged = upsert(target, source, broadcast_bytes=limit, with_action=True)
    assert rows(merged) == [
        (1, "a", "kept"),
        (2, "B", "updated"),
        (3, "C", "updated"),
        (3, "C", "updated"),
        (9, "new", "inserted"),
        (None, "m", "inserted"),
        (None, "n", "kept"),
    ]
    assert rows(merge_metrics(merged)) == [("inserted", 2), ("kept", 2), ("updated", 3)]


def test_repeating_an_upsert_changes_nothing(spark, target):
    source = spark.createDataFrame([(2, "B"), (9, "new")], KV)
    once = upsert(target, source)
    assert rows(upsert(once, source)) == rows(once)


def test_first_clause_whose_condition_holds(spark, target):
    source = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (7, "z"), (8, None)], KV)
    merged = merge(
        target,
        source,
        "k",
        [WhenMatched({"v": "'one'"}, "t.k = 1"), WhenMatched({"t.V": F.lit("other")}, "s.v IS NOT NULL")],
        [WhenNotMatched({"k": "s.k", "v": "upper(s.v)"}, "s.v IS NOT NULL")],
    )
    assert rows(merged) == [(1, "one"), (2, "other"), (3, "c"), (3, "c2"), (7, "Z"), (None, "n")]


def test_two_change_rows_for_one_target_row(spark, target):
    with pytest.raises(AmbiguousMergeError):
        upsert(target, spark.createDataFrame([(1, "x"), (1, "y")], KV))


def test_repeated_keys_that_match_nothing_are_inserted(spark, target):
    source = spark.createDataFrame([(8, "x"), (8, "y"), (None, "p"), (None, "p")], KV)
    merged = upsert(target, source)
    assert merged.where("k = 8").count() == 2
    assert merged.where("v = 'p'").count() == 2


def test_repeated_keys_without_update_clause(spark, target):
    source = spark.createDataFrame([(1, "x"), (1, "y"), (8, "z")], KV)
    assert rows(merge(target, source, "k", not_matched=[WhenNotMatched()])) == sorted(
        rows(target) + [(8, "z")], key=lambda r: (r[0] is None, str(r))
    )


def test_empty_change_set(spark, target):
    assert rows(upsert(target, spark.createDataFrame([], KV))) == rows(target)


def test_values_take_the_type_of_the_target(spark):
    target = spark.createDataFrame([(1, 10)], "k int, amount int")
    source = spark.createDataFrame([(1, "11"), (2, "12")], "k long, amount string")
    merged = upsert(target, source)
    assert merged.dtypes == [("k", "int"), ("amount", "int")]
    assert rows(merged) == [(1, 11), (2, 12)]


def test_columns_without_evolution(spark):
    target = spark.createDataFrame([(1, "a", 5)], "k long, v string, w int")
    with pytest.raises(ValueError, match="lacks"):
        upsert(target, spark.createDataFrame([(1, "b")], KV))
    wider = spark.createDataFrame([(1, "b", 6, "extra")], "k long, v string, w int, x string")
    assert rows(upsert(target, wider)) == [(1, "b", 6)]


def test_evolution_keeps_missing_and_adds_new_columns(spark):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k long, v string, w int")
    source = spark.createDataFrame([(1, "A", "x"), (3, "C", "y")], "K long, V string, x string")
    merged = upsert(target, source, evolve=True)
    assert merged.columns == ["k", "v", "w", "x"]
    assert rows(merged) == [(1, "A", 5, "x"), (2, "b", 6, None), (3, "C", None, "y")]


def test_daily_reports(spark):
    """A state-level report is corrected and 39 county reports arrive with four more columns."""
    old_columns = """Province_State string, Country_Region string, Last_Update string, Confirmed int,
        Deaths int, Recovered int, Latitude double, Longitude double, process_date string, level int"""
    old = spark.createDataFrame(
        [("Washington", "US", "2020-03-21T10:00:00", 12, 3, 1, 1.5, 2.5, "2020-03-21", 2)], old_columns
    )
    new_columns = f"FIPS int, Admin2 string, {old_columns}, Active int, Combined_Key string"

    def report(fips, county, day, level):
        return (fips, county, "Washington", "US", f"{day}T19:00:00", fips, 0, 0, 1.5, 2.5, day, level, None, "")

    counties = [report(53001 + i, f"county {i}", "2020-04-11", 3) for i in range(39)]
    new = spark.createDataFrame(counties + [report(53, "", "2020-03-21", 2)], new_columns)
    keys = ["process_date", "province_state", "country_region", "level"]
    # The county rows share one key, which the target does not have.
    merged = upsert(old, new, keys, evolve=True, with_action=True)
    assert merged.count() == 40
    assert len(merged.drop("_action").columns) == 14
    assert merged.columns[:10] == old.columns
    assert rows(merge_metrics(merged)) == [("inserted", 39), ("updated", 1)]
    assert merged.where("level = 2").select("FIPS", "Last_Update").collect() == [(53, "2020-03-21T19:00:00")]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    draw = random.Random(seed)
    keys = [None, *range(12)]
    target = [(draw.choice(keys), draw.choice("ab"), draw.choice([None, 1, 2])) for _ in range(25)]
    source = [(k, draw.choice("xy"), draw.choice([None, 1, 2])) for k in draw.sample(range(20), 10)]
    source += [(None, "x", 1), (None, "y", None)]
    by_key = {k: (v, n) for k, v, n in source if k is not None}

    expected = []
    for k, v, n in target:
        change = by_key.get(k)
        # n differs: unknown when either is null
        if change and n is not None and change[1] is not None and n != change[1]:
            expected.append((k, change[0], n, "updated"))
        else:
            expected.append((k, v, n, "kept"))
    known = {k for k, _, _ in target}
    expected += [(k, v, n, "inserted") for k, v, n in source if v == "x" and (k is None or k not in known)]

    schema = "k int, v string, n int"
    for limit in (0, 1 << 20):
        merged = merge(
            spark.createDataFrame(target, schema),
            spark.createDataFrame(source, schema),
            "k",
            [WhenMatched({"v": "s.v"}, "t.n <> s.n")],
            [WhenNotMatched(None, "s.v = 'x'")],
            with_action=True,
            broadcast_bytes=limit,
        )
        assert rows(merged) == sorted(expected, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_keys_of_two_types(spark, limit):
    """Above and below the broadcast limit the same rows come out."""
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    source = spark.createDataFrame([(1, "A"), (2, "B"), (9, "Z")], KV)
    assert rows(upsert(target, source, broadcast_bytes=limit)) == [(1, "A"), (2, "B"), (3, "c"), (9, "Z")]


def test_small_change_set_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(1000).selectExpr("id AS k", "cast(id AS string) AS v").write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    source = spark.createDataFrame([(5, "x"), (5000, "y")], KV)
    text = plan(upsert(target, source))
    assert "SortMergeJoin" not in text
    assert text.count("Exchange hashpartitioning") == 1  # distinct keys that both sides have


def test_skewed_target_is_split(spark, tmp_path, conf):
    """A third of the rows under one key: adaptive execution splits their partition."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
    )
    spark.range(0, 60000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "uuid() AS v"
    ).write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    source = spark.range(0, 3000, 1, 8).selectExpr("id * 30 AS k", "uuid() AS v")
    merged = upsert(target, source, broadcast_bytes=0)
    merged.collect()
    assert "skew=true" in plan(merged)
    assert merged.where("k = 7").count() == target.where("k = 7").count()


def test_columns_of_the_user_are_kept(spark):
    target = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "k int, _action string, _matched_source string")
    source = spark.createDataFrame([(2, "x", "y"), (3, "z", None)], "k int, _action string, _matched_source string")
    merged = merge(target, source, "k", [WhenMatched()], [WhenNotMatched()])
    assert rows(merged) == [(1, "a", "b"), (2, "x", "y"), (3, "z", None)]
    with pytest.raises(ValueError, match="_action"):
        merge(target, source, "k", [WhenMatched()], [WhenNotMatched()], with_action=True)
