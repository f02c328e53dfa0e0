import hashlib

import numpy as np

import brute
from tidemark.llm import fingerprints as fp


def test_edits_neighbours_and_likeness(spark):
    docs = [(i * 3 - 50, brute.prose(i // 2, 20 + i % 30)) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = {r["id"]: r for r in fp.compare_with_edits(df, rows_per_range=10).collect()}
    docs.sort(reverse=True)
    errors, texts = [], {}
    for (i, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        r = found[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        errors.append(r["near_edited"] - brute.jaccard(brute.words(text), brute.words(changed)))
        errors.append(r["near_next"] - brute.jaccard(brute.words(text), brute.words(following)))
        assert texts.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.3


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    """Weights that differ, over many draws."""
    one, other = {"a": 5, "b": 1, "c": 2, "d": 9}, {"a": 2, "b": 1, "c": 6, "e": 3}
    rows = [(k, hash(w) % 10**9, n) for k, ws in ((1, one), (2, other)) for w, n in ws.items()]
    drawn = fp.draws(spark.createDataFrame(rows, "k int, term long, n long"), ["k"], 2048)
    a, b = (np.concatenate([r["drawn"] for r in sorted(drawn.where(f"k = {k}").collect(), key=lambda r: r["part"])]) for k in (1, 2))
    terms = lambda ws: [w for w, n in ws.items() for _ in range(n)]
    assert abs((a == b).mean() - brute.jaccard(terms(one), terms(other))) < 0.04


def test_quantiles():
    for p in (0.001, 0.5, 0.99):
        x = fp._gamma_quantile(p)
        assert abs(1 - (1 + x) * np.exp(-x) - p) < 1e-9


def test_one_row_and_texts_without_words(spark):
    df = spark.createDataFrame([(5, "a b c")], "doc_id long, text string")
    assert fp.compare_with_edits(df).first()["near_next"] == 1.0
    df = spark.createDataFrame([(1, None), (2, " "), (3, "x")], "doc_id long, text string")
    found = {r["id"]: r for r in fp.compare_with_edits(df).collect()}
    assert found[1]["fingerprint"] == found[2]["fingerprint"] != found[3]["fingerprint"]
    assert (found[2]["near_next"], found[3]["near_next"]) == (1.0, 0.0)


def _check_ring(rows, found):
    """Each row's next text is that of the next row in descending order of id and hash, the last one's the first's."""
    assert len(found) == len(rows)
    expected = sorted(rows, key=lambda r: (r["id"] is not None, r["id"] or type(rows[0]["id"])(), r["tie"]), reverse=True)
    nexts = sorted((repr(a["id"]), a["text"], b["text"]) for a, b in zip(expected, expected[1:] + expected[:1]))
    assert sorted((repr(r["id"]), r["text"], r["next"]) for r in found) == nexts


def test_rows_of_one_id_are_spread(spark):
    """A third of all rows under one id; ids of other types; null ids."""
    rows = [(7 if i % 3 == 0 else i, f"text {i}") for i in range(900)] + [(None, "x"), (None, "y")]
    for kind in ("long", "string"):
        df = spark.createDataFrame(rows, "id long, text string").selectExpr(f"cast(id AS {kind}) AS id", "text").repartition(4)
        beside = fp.neighbours(df, "id", "text", 50)
        sizes = [r["count"] for r in beside.groupBy("range").count().collect()]
        assert len(sizes) > 10 and max(sizes) < 250
        _check_ring(df.selectExpr("*", "xxhash64(text) AS tie").collect(), beside.where("guest = 0").collect())


def test_copies_of_one_row_are_spread(spark):
    rows = [(1, "same text")] * 600 + [(i, f"text {i}") for i in range(2, 302)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(4)
    beside = fp.neighbours(df, "id", "text", 50)
    assert max(r["count"] for r in beside.groupBy("range").count().collect()) < 250
    _check_ring(df.selectExpr("*", "xxhash64(text) AS tie").collect(), beside.where("guest = 0").collect())


def test_awkward_rows(spark):
    df = brute.awkward(spark)
    assert fp.compare_with_edits(df).count() == df.count()
    assert fp.compare_with_edits(brute.empty(spark)).isEmpty()
    assert fp.fingerprints(df).where("fingerprint IS NULL").isEmpty()
