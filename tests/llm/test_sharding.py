import pytest
from pyspark.sql import functions as F

import brute
from tidemark.llm import sharding


def keyed(df):
    return df.select("doc_id", *sharding.place_columns(df, "doc_id", "text"))


def plain(rows, shards):
    """Exact weighted medians, by sorting; rows of (id, size, group, tie, axes)."""
    axes = range(len(rows[0][4]))
    span = [max(1, max(r[4][a] for r in rows) - min(r[4][a] for r in rows)) for a in axes]

    def cut(rows, first, k):
        if k == 1 or not rows:
            return {r[0]: first for r in rows}
        width = [(max(r[4][a] for r in rows) - min(r[4][a] for r in rows)) / span[a] for a in axes]
        axis = max(axes, key=lambda a: (width[a], -a))
        rows = sorted(rows, key=lambda r: (r[4][axis], r[2], r[3]))
        goal, below = sum(r[1] for r in rows) * (k // 2) / k, 0
        at = 0
        while below + rows[at][1] < goal:
            below, at = below + rows[at][1], at + 1
        at += 0 if 2 * (goal - below) <= rows[at][1] else 1
        return cut(rows[:at], first, k // 2) | cut(rows[at:], first + k // 2, k - k // 2)

    return cut(rows, 0, shards)


@pytest.mark.parametrize("shards", [8, 5, 1])
def test_exact_medians(spark, monkeypatch, shards):
    """Without tolerance the cuts are those of a sort; a third of the texts are alike."""
    monkeypatch.setattr(sharding, "TOLERANCE", 0.0)
    monkeypatch.setattr(sharding, "GROUP_TOLERANCE", 0.0)
    monkeypatch.setattr(sharding, "BUCKETS", 16)
    docs = [(i, "same text here" if i % 3 == 0 else brute.prose(i, 1 + i * 7 % 40)) for i in range(300)]
    df = keyed(spark.createDataFrame(docs, "doc_id long, text string"))
    placed = sharding.place(df, sharding.grow(df.drop("doc_id"), shards))
    got = {r["doc_id"]: r["node"] for r in placed.collect()}
    assert got == plain([tuple(r) for r in df.collect()], shards)


def test_near_equal_bytes_whole_groups_and_slots(spark):
    docs = [(i, brute.prose(i // 2, 5 + i % 2 * 0 + (i // 2) % 60)) for i in range(4000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = sharding.shard(df, 8)
    sizes = found.groupBy("shard").agg(F.sum(sharding.byte_size(F.col("text"))).alias("b"), F.count("*").alias("n"), F.max("slot"), F.countDistinct("slot").alias("d")).collect()
    assert [r["shard"] for r in sorted(sizes)] == list(range(8))
    assert max(r["b"] for r in sizes) < 1.02 * min(r["b"] for r in sizes)
    assert all(r["n"] == r["d"] == r["max(slot)"] + 1 for r in sizes)
    assert found.groupBy("text").agg(F.countDistinct("shard").alias("s")).where("s > 1").isEmpty()


def test_slots_of_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_CHUNK", 20)
    df = spark.range(500).selectExpr("id AS doc_id", "concat('text ', id % 90) AS text")
    found = sharding.shard(df, 3).groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("b"), F.countDistinct("slot").alias("d"))
    assert all((r["a"], r["b"], r["d"]) == (0, r["n"] - 1, r["n"]) for r in found.collect())


def test_target_bytes(spark):
    df = spark.range(100).selectExpr("id AS doc_id", "repeat('x', 99) AS text")
    assert sharding.shard(df, target_bytes=1000).select("shard").distinct().count() == 10


def test_awkward_rows(spark):
    df = brute.awkward(spark)
    found = sharding.shard(df, 4)
    assert found.count() == df.count() and found.where("shard IS NULL OR slot IS NULL").isEmpty()
    more = sharding.shard(df, 4, dimensions=["source", "n_chars"])
    assert more.count() == df.count()
    assert sharding.shard(brute.empty(spark), 4).isEmpty()
