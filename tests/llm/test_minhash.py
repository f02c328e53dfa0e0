import random

import numpy as np
import pytest

import brute
from tidemark.llm import minhash, stars


def shingles(text, k):
    ws = brute.words(text)
    return {tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set()


def plain(docs, k, percent):
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text), by comparing all pairs."""
    sets = [shingles(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    root[find(i)] = find(j)
    least = {}
    for i, (ident, _) in enumerate(docs):
        if ident is not None:
            least[find(i)] = min(ident, least.get(find(i), ident))
    out = [(ident, len(s), least.get(find(i)) if s else ident) for i, ((ident, _), s) in enumerate(zip(docs, sets))]
    return sorted(((*r, r[0] == r[2]) for r in out), key=str)


def found(df, **kw):
    return sorted((tuple(r) for r in minhash.near_duplicates(df, **kw).collect()), key=str)


def copies(seed, families, members, edits):
    """Families of near copies, each with some words replaced, from alike to beyond any threshold."""
    draw = random.Random(seed)
    texts = []
    for f in range(families):
        base = brute.prose(seed * 100 + f, 120).split()
        for _ in range(members):
            words = list(base)
            for _ in range(draw.randint(0, edits)):
                words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
            texts.append(" ".join(words))
    return [(1000 - i if i % 3 else 2000 + i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("k, percent, block_nodes, block_shingles", [(3, 85, 2048, 1 << 20), (5, 80, 16, 500), (2, 60, 7, 100)])
def test_against_all_pairs(spark, monkeypatch, k, percent, block_nodes, block_shingles):
    """Families around the threshold, also when buckets and families are cut into many blocks."""
    monkeypatch.setattr(minhash, "BLOCK_NODES", block_nodes)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block_shingles)
    docs = copies(k, 4, 45, 9) + copies(k + 20, 30, 2, 4) + [(i, brute.prose(900 + i, 40)) for i in range(30)]
    docs += [(None, docs[0][1]), (5, docs[0][1]), (5, docs[0][1]), (6, "A b"), (7, "a B"), (8, "a"), (9, ""), (10, None), (11, " \n")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    expected = plain(docs, k, percent)
    assert len({r[2] for r in expected}) < len(expected)
    assert found(df, words_per_shingle=k, percent=percent) == expected


def test_links_that_leaders_do_not_show(spark):
    """Two chains whose least members are not alike, with links only between later members."""
    base = brute.prose(5, 200).split()
    step = [" ".join(base[i : i + 150]) for i in range(0, 45, 5)]
    docs = [(i, t) for i, t in enumerate(step[::-1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(df, words_per_shingle=3, percent=85) == plain(docs, 3, 85)


def test_bands_keep_pairs_at_the_threshold():
    for percent in (60, 80, 85, 95):
        missed = (1 - (percent / 100) ** minhash.ROWS) ** minhash.bands_for(percent)
        assert missed <= minhash.MISS


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(3)
    functions = minhash.hash_functions(160)
    for share in (0.5, 0.85, 0.95):
        seen = []
        for _ in range(60):
            x = np.unique(draw.integers(0, 2**64, 1000, dtype=np.uint64))
            n = int(len(x) * 2 * share / (1 + share))
            y = np.concatenate([x[:n], draw.integers(0, 2**64, len(x) - n, dtype=np.uint64)])
            seen.append((minhash.signature(x, functions) == minhash.signature(y, functions)).mean())
        assert abs(np.mean(seen) - share) < 0.02
        assert min(seen) > minhash.least_agreement(int(100 * share), 160)


def test_spanning_links_follow_labels():
    near = {(0, 3), (3, 0), (1, 4), (4, 1)}
    tried = []

    def linked(i, others):
        tried.append(i)
        return np.array([(i, j) in near for j in others.tolist()])

    a, b = minhash.spanning(6, np.array([7, 7, 8, 8, 9, 10]), linked)
    assert {frozenset(x) for x in zip(a, b)} == {frozenset(x) for x in [(0, 3), (1, 4)]}


def test_components_of_a_large_star_and_a_chain(spark):
    star = spark.range(1, 20_000).selectExpr("0 AS a", "id AS b")
    chain = spark.range(30_000, 30_300).selectExpr("id + 1 AS a", "id AS b")
    self_ = spark.range(40_000, 40_001).selectExpr("id AS a", "id AS b")
    got = {r["node"]: r["root"] for r in stars.components(star.unionByName(chain).unionByName(chain).unionByName(self_)).collect()}
    assert got == {i: 0 for i in range(1, 20_000)} | {30_000 + i: 30_000 for i in range(1, 301)}
    assert stars.components(star.limit(0)).isEmpty()


def test_awkward_rows(spark):
    docs = brute.awkward(spark)
    assert found(docs) == plain([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80)
    assert minhash.near_duplicates(brute.empty(spark)).isEmpty()
    text_ids = docs.selectExpr("concat('d', doc_id) AS doc_id", "text")
    assert sum(not r["kept"] for r in minhash.near_duplicates(text_ids).collect()) == 2
