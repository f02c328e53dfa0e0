import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import brute
from conftest import rows
from tidemark.llm import divergence, op12

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(docs, least=30, top=50):
    """All rows of op12 from (lang, source, text)."""
    docs = [tuple(x or "" for x in d) for d in docs]
    out = []
    for lang in {d[0] for d in docs}:
        counts, df = defaultdict(Counter), Counter()
        for _, source, text in (d for d in docs if d[0] == lang):
            terms = TERM.findall(brute.ascii_lower(text))
            counts[source].update(terms)
            df.update(set(terms))
        kept = [t for t in df if df[t] >= least]
        total = {s: sum(c[t] for t in kept) for s, c in counts.items()}
        p = {s: {t: 1 + 10**9 * (counts[s][t] + 5) // (total[s] + 5 * len(kept)) for t in kept} for s in counts}
        whole = sum(counts.values(), Counter())
        q = {t: 1 + 10**9 * (whole[t] + 5) // (sum(total.values()) + 5 * len(kept)) for t in kept}
        for s in counts:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, last in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(found[:last], 1)]
    return sorted(out)


def corpus(seed, n, sources):
    draw = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}É" for i in draw.zipf(1.3, 30).clip(1, 400)]
        out.append((["en", "de", None][draw.integers(3)], [f"s{draw.integers(sources)}", None][draw.random() < 0.05], " 7|".join(words)))
    return out + [("fr", "lonely", None), ("fr", "x", "Ab"), ("it", None, "")]


def found(spark, docs, parts=3):
    return rows(divergence.divergences(spark.createDataFrame(docs, "lang string, source string, text string").repartition(parts)))


@pytest.mark.parametrize("block, cells", [(256, 1 << 20), (3, 50), (1, 1)])
def test_against_plain_counting(spark, monkeypatch, block, cells):
    """Also with many spills and with sources in several blocks."""
    docs = corpus(block, 400, 11)
    whole, spilled = divergence.stripes, []

    def small(given, least, _=None):
        spilled.append(1)
        return whole(given, least, cells)

    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "stripes", small)
    assert sorted(found(spark, docs)) == plain(docs) and spilled


def test_shares_are_exact():
    draw = np.random.default_rng(2)
    totals = draw.integers(1, 2 * 10**14, 1000)
    counts = (totals * draw.random(1000)).astype(np.int64)
    exact = [1 + 10**9 * (int(c) + 5) // (int(t) + 5) for c, t in zip(counts, totals)]
    assert divergence.shares(counts, totals + 5).tolist() == exact


def test_stripes_of_one_frequent_word_meet_as_few_rows(spark):
    docs = spark.range(0, 20_000, 1, 4).selectExpr("'en' AS lang", "'a' AS source", "'the the cat' AS text")
    merged = rows(divergence.stripes(docs, 1))
    assert merged == [("en", "cat", 20_000, ["a"], [20_000]), ("en", "the", 20_000, ["a"], [40_000])]


def test_awkward_rows(spark):
    docs = brute.awkward(spark)
    expected = plain([(r["lang"], r["source"], r["text"]) for r in docs.collect()])
    assert sorted(rows(divergence.divergences(docs))) == expected
    assert divergence.divergences(brute.empty(spark)).isEmpty()


def test_top_terms_are_cut_before_the_shuffle(spark):
    text = op12.op12_audit_source_divergence(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in text
