"""Every stage against what it must do with the rows of its predecessor."""

import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from test_decontamination import best_similarity
from test_mixing import plain as plain_mix
from test_simhash import components, fingerprint

sys.path.insert(0, __file__.rsplit("/", 3)[0])
import corpus_pipeline  # noqa: E402
from tidemark.session import materialize  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, materialize(stage(spark, docs, SF_DIR), name)
        out.append((name, given, docs))
    return out


def test_stages_and_columns(spark, stages):
    names = ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert [n for n, _, _ in stages] == names
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    assert all(kept.columns == columns for _, _, kept in stages[:-1])


def test_quality_keeps_good_documents(spark, stages):
    _, given, kept = stages[0]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rejected = given.join(kept, "doc_id", "left_anti").join(labels, "doc_id")
    assert rejected.where("quality = 1").count() <= 1
    assert kept.exceptAll(given).isEmpty()


def test_one_of_each_group_stays(stages):
    _, given, kept = stages[1]
    rows = sorted((r["doc_id"], fingerprint(r["text"])) for r in given.select("doc_id", "text").collect())
    label = components([p for _, p in rows])
    assert {r["doc_id"] for r in kept.collect()} == {rows[i][0] for i in set(label.tolist())}


def test_contaminated_documents_go(spark, stages):
    _, given, kept = stages[2]
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    known = [set(zip(*(x.lower().split()[i:] for i in range(3)))) for x in items]
    expected = set()
    for r in given.collect():
        own = set(zip(*(r["text"].lower().split()[i:] for i in range(3))))
        if not any(own & k and best_similarity(r["text"], x) >= 0.8 for k, x in zip(known, items)):
            expected.add(r["doc_id"])
    assert {r["doc_id"] for r in kept.collect()} == expected


def test_mix(stages):
    _, given, kept = stages[3]
    expected = plain_mix([(r["doc_id"], r["text"], r["source"]) for r in given.collect()])
    found = Counter((r["doc_id"], r["text"], r["source"]) for r in kept.collect())
    assert all(found[k] == copies or size == 0 for k, (copies, size) in expected.items())


def test_shards(stages):
    _, given, kept = stages[4]
    assert kept.drop("shard", "slot").exceptAll(given).isEmpty() and kept.count() == given.count()
    sizes = [r[0] for r in kept.groupBy("shard").agg(F.sum(F.octet_length("text"))).drop("shard").collect()]
    assert len(sizes) == 8 and max(sizes) < 1.5 * np.mean(sizes)


def test_shards_grow_with_the_bytes(spark, monkeypatch):
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    total = given.agg(F.sum(F.octet_length("text"))).first()[0]
    monkeypatch.setattr(corpus_pipeline, "SHARD_BYTES", total // 19)
    found = corpus_pipeline.sharding_stage(spark, given, SF_DIR)
    assert found.select("shard").distinct().count() in (19, 20)


@pytest.mark.parametrize("kind", ["awkward", "empty"])
def test_awkward_and_empty_documents(spark, kind):
    docs = getattr(brute, kind)(spark)
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = materialize(stage(spark, docs, SF_DIR), name)
        assert set(columns) <= set(docs.columns)
        if kind == "awkward":
            assert [r[0] for r in docs.select("copies").distinct().collect()] == ["copies"], name
    assert docs.isEmpty() == (kind == "empty")
