import random

import numpy as np
import pytest
import xxhash

import brute
from tidemark.llm import gray_index, simhash


def fingerprint(text, k=4):
    ws = brute.words(text)
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=4):
    """The least member of the component of each value, by comparing all pairs."""
    prints = np.array(prints, dtype=np.uint64)
    label = np.arange(len(prints))
    while True:
        new = label.copy()
        for i in range(len(prints)):
            near = np.bitwise_count(prints ^ prints[i]) <= radius
            new[i] = label[near].min()
        if np.array_equal(new, label):
            return label
        label = new


def test_fingerprints_against_brute_force(spark):
    texts = [brute.prose(i, 1 + i * 3) for i in range(12)] + ["", None, " \n", "a", "A b\tC", "é É"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in simhash.with_fingerprint(df).collect():
        assert r["fingerprint"] % 2**64 == fingerprint(texts[r["doc_id"]])


def clouds(seed, centers, members, flips):
    draw = random.Random(seed)
    out = set()
    for _ in range(centers):
        center = draw.getrandbits(64)
        for _ in range(members):
            out.add(center ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, flips))))
    return sorted(out)


def gray(x):
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> s
    return x


@pytest.mark.parametrize("centers, members, flips", [(60, 1, 0), (5, 60, 3), (1, 500, 6), (3, 200, 9)])
def test_index_against_all_pairs(monkeypatch, centers, members, flips):
    """One block, from scattered to dense; also with a frontier that has to be cut."""
    prints = sorted(clouds(7, centers, members, flips), key=gray)
    expected = components(prints)
    for frontier in (1 << 20, 64):
        monkeypatch.setattr(gray_index, "FRONTIER", frontier)
        leaf, root = gray_index.spanning_links(np.array(prints, dtype=np.uint64), np.array([0]), 4)
        label = np.arange(len(prints))
        label[leaf] = root
        assert np.array_equal(label, expected)


@pytest.mark.parametrize("crowd", [10**6, 20])
def test_groups_against_all_pairs(spark, crowd):
    """Also where places with more than 20 fingerprints are dealt again."""
    prints = clouds(3, 4, 80, 6) + clouds(4, 100, 1, 0) + [0, 1, 2**64 - 1]
    docs = [(1000 - i, p - 2**64 if p >> 63 else p) for i, p in enumerate(prints + prints[:50])]
    df = spark.createDataFrame(docs, "doc_id long, fingerprint long")
    group = {r["print"] % 2**64: r["component_id"] for r in simhash.components(df, crowd=crowd).collect()}
    label = components(prints)
    least = {}
    for (i, _), p in zip(docs, prints + prints[:50]):
        root = label[prints.index(p)]
        least[root] = min(least.get(root, i), i)
    assert group == {p: least[label[k]] for k, p in enumerate(prints)}


def test_long_chains_are_one_component(spark):
    edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b").unionByName(spark.range(1000, 1020).selectExpr("1000 AS a", "id AS b"))
    found = {r["node"]: r["root"] for r in simhash.connected(edges).collect()}
    assert found == {i: 0 for i in range(1, 301)} | {i: 1000 for i in range(1001, 1020)}


def test_one_of_each(spark):
    base = brute.prose(1, 400)
    docs = [(5, base), (3, base + " x"), (9, base), (9, base), (4, brute.prose(2, 400)), (None, brute.prose(3, 400)), (None, brute.prose(3, 400))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = sorted((r["doc_id"] is None, r["doc_id"]) for r in simhash.one_of_each(df).collect())
    assert kept == [(False, 3), (False, 4), (True, None)]


def test_rows_that_stay_are_not_shuffled(spark):
    """Equal rows, equal ids with other texts, and rows that differ in another column only; few rows go."""
    texts = [brute.prose(i, 40) for i in range(60)]
    docs = [(i, t, "a") for i, t in enumerate(texts)] + [(0, texts[0], "a")] * 3 + [(1, texts[1], c) for c in "bcd"] + [(2, texts[0], "e")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(7)
    kept = simhash.one_of_each(df)
    found = kept.collect()
    assert sorted((r["doc_id"], r["text"]) for r in found) == list(enumerate(texts))
    least = min(df.where("doc_id = 1").selectExpr("xxhash64(doc_id, text, source) AS h", "source").collect())
    assert [r["source"] for r in found if r["doc_id"] == 1] == [least["source"]]
    plan = simhash.one_of_each(df.where("doc_id > 1"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan


def test_awkward_rows(spark):
    df = brute.awkward(spark)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    texts = [r["text"] for r in kept.collect()]
    assert len(texts) == len({fingerprint(t) for t in texts})
    assert sum(not brute.words(t) for t in texts) == 1
    assert simhash.one_of_each(brute.empty(spark)).isEmpty()
