import datetime
import random

import pytest

from conftest import rows
from tidemark.operators import scd2
from tidemark.operators.merge import AmbiguousMergeError

DAY = datetime.date
DIMENSION = "k int, name string, region string, effective_date date, end_date date, is_current boolean"
UPDATES = "k int, name string, region string, effective_date date"
TRACKED = ["name", "region"]
FORMS = [scd2.merge_changes, scd2.apply_changes]


@pytest.mark.parametrize("form", FORMS)
def test_people(spark, form):
    """One moves, one is new, one stays, and one that was closed comes back."""
    people = spark.createDataFrame(
        [
            (10, "Ravi", "north", DAY(2001, 3, 1), None, True),
            (11, "Mona", "south", DAY(2002, 3, 1), None, True),
            (12, "Ines", "east", DAY(2003, 3, 1), DAY(2004, 3, 1), False),
        ],
        DIMENSION,
    )
    changes = spark.createDataFrame(
        [
            (10, "Ravi", "west", DAY(2010, 5, 5)),
            (17, "Olek", "south", DAY(2011, 5, 5)),
            (12, "Ines", "north", DAY(2012, 5, 5)),
        ],
        UPDATES,
    )
    assert rows(form(people, changes, "k", TRACKED)) == [
        (10, "Ravi", "north", DAY(2001, 3, 1), DAY(2010, 5, 5), False),
        (10, "Ravi", "west", DAY(2010, 5, 5), None, True),
        (11, "Mona", "south", DAY(2002, 3, 1), None, True),
        (12, "Ines", "east", DAY(2003, 3, 1), DAY(2004, 3, 1), False),
        (12, "Ines", "north", DAY(2012, 5, 5), None, True),
        (17, "Olek", "south", DAY(2011, 5, 5), None, True),
    ]


@pytest.mark.parametrize("form", FORMS)
def test_stale_updates(spark, form):
    """An update from before the version that it would close is refused, or skipped if asked for."""
    target = spark.createDataFrame([(1, "a", "x", DAY(2020, 1, 1), None, True)], DIMENSION)
    changes = spark.createDataFrame([(1, "b", "x", DAY(2019, 1, 1)), (2, "n", "x", DAY(2019, 1, 1))], UPDATES)
    with pytest.raises(Exception, match="stale update of key 1"):
        form(target, changes, "k", TRACKED).collect()
    assert rows(form(target, changes, "k", TRACKED, stale="skip")) == [
        (1, "a", "x", DAY(2020, 1, 1), None, True),
        (2, "n", "x", DAY(2019, 1, 1), None, True),
    ]
    with pytest.raises(ValueError):
        form(target, changes, "k", TRACKED, stale="perhaps")


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_keys_of_two_types(spark, form, limit):
    target = spark.createDataFrame([(1, "a", "x", DAY(2020, 1, 1), None, True)], DIMENSION)
    changes = spark.createDataFrame(
        [(1, "b", "x", DAY(2021, 1, 1)), (9, "c", "x", DAY(2021, 1, 1))], UPDATES.replace("k int", "k long")
    )
    found = form(target, changes, "k", TRACKED, broadcast_bytes=limit)
    assert sorted((r["k"], r["name"], r["is_current"]) for r in found.collect()) == [
        (1, "a", False), (1, "b", True), (9, "c", True),
    ]


def history(seed):
    draw = random.Random(seed)
    dimension, updates = [], []
    for k in range(30):
        start = DAY(1990, 1, 1)
        for _ in range(draw.randrange(3)):
            end = start + datetime.timedelta(days=100)
            dimension.append((k, draw.choice("ab"), "old", start, end, False))
            start = end
        if draw.random() < 0.8:
            dimension.append((k, draw.choice("ab"), draw.choice(["x", "y", None]), start, None, True))
        if draw.random() < 0.6:
            updates.append((k, draw.choice("ab"), draw.choice(["x", "y", None]), DAY(2000, 1, 1)))
    updates += [(None, "a", "x", DAY(2000, 1, 1)), (100, "a", None, DAY(2000, 1, 1))]
    return dimension, updates


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_both_forms_against_brute_force(spark, seed, limit):
    dimension, updates = history(seed)
    by_key = {u[0]: u for u in updates if u[0] is not None}
    expected = []
    for k, name, region, start, end, current in dimension:
        u = by_key.get(k)
        if current and u and (name, region) != u[1:3]:
            expected += [(k, name, region, start, u[3], False), (*u, None, True)]
        else:
            expected.append((k, name, region, start, end, current))
    open_keys = {d[0] for d in dimension if d[5]}
    expected += [(*u, None, True) for u in updates if u[0] not in open_keys]
    expected.sort(key=lambda r: tuple((v is None, str(v)) for v in r))

    target = spark.createDataFrame(dimension, DIMENSION)
    changes = spark.createDataFrame(updates, UPDATES)
    for form in FORMS:
        found = form(target, changes, "k", TRACKED, broadcast_bytes=limit)
        assert rows(found) == expected
        assert found.where("is_current AND k IS NOT NULL").groupBy("k").count().where("count > 1").isEmpty()
        assert found.where("end_date < effective_date").isEmpty()


@pytest.mark.parametrize("form", FORMS)
def test_applying_twice(spark, form):
    dimension, updates = history(5)
    changes = spark.createDataFrame([u for u in updates if u[0] is not None], UPDATES)
    once = form(spark.createDataFrame(dimension, DIMENSION), changes, "k", TRACKED)
    assert rows(form(once, changes, "k", TRACKED)) == rows(once)
    assert once.where("is_current").groupBy("k").count().where("count > 1").isEmpty()


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("key", [1, 2])
def test_two_updates_for_one_key(spark, form, key):
    """Whether the dimension knows it or not."""
    target = spark.createDataFrame([(1, "a", "x", DAY(1990, 1, 1), None, True)], DIMENSION)
    changes = spark.createDataFrame(
        [(key, "b", "x", DAY(2000, 1, 1)), (key, "c", "x", DAY(2000, 1, 1))], UPDATES
    )
    with pytest.raises(AmbiguousMergeError):
        form(target, changes, "k", TRACKED)


def test_merge_metrics_of_changes(spark):
    target = spark.createDataFrame([(1, "a", "x", DAY(1990, 1, 1), None, True)], DIMENSION)
    changes = spark.createDataFrame([(1, "b", "x", DAY(2000, 1, 1))], UPDATES)
    merged = scd2.merge_changes(target, changes, "k", TRACKED, with_action=True)
    assert sorted(r["_action"] for r in merged.collect()) == ["inserted", "updated"]


def test_active_and_inactive(spark):
    target = spark.createDataFrame(history(1)[0], DIMENSION)
    assert scd2.active(target).count() + scd2.inactive(target).count() == target.count()
    assert scd2.inactive(target).where("is_current").isEmpty()
