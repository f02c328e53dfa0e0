import hashlib
from collections import defaultdict

import pytest

import brute
from tidemark.llm import mixing


def plain(docs, weights=(5, 2, 1), most=3):
    """Copies of each (id, text, source), by sorting every source."""
    size = lambda t: len(brute.words(t))
    name = lambda i, t: str(i) if i is not None else "null:" + (t or "")
    sources = sorted({s for _, _, s in docs}, key=lambda s: (s is None, s))
    total = {s: sum(size(t) for _, t, x in docs if x == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    full, level = set(), 0.0
    while len(full) < len(sources):
        level = (sum(total.values()) - sum(most * total[s] for s in full)) / sum(w for s, w in weight.items() if s not in full)
        more = {s for s in sources if s not in full and most * total[s] <= level * weight[s]}
        if not more:
            break
        full |= more
    out = {}
    for s in sources:
        target = min(level * weight[s], most * total[s])
        whole = int(target // max(1, total[s]))
        left, tied = target - whole * total[s], defaultdict(int)
        for i, t, x in docs:
            if x == s:
                tied[int(hashlib.md5(name(i, t).encode()).hexdigest()[:15], 16)] += size(t)
        taken = set()
        for h in sorted(tied):
            if left <= 0:
                break
            if tied[h] <= left or 2 * left >= tied[h]:
                taken.add(h)
            left -= tied[h]
        for i, t, x in docs:
            if x == s:
                h = int(hashlib.md5(name(i, t).encode()).hexdigest()[:15], 16)
                out[i, t, s] = (whole + (h in taken), size(t))
    return out


@pytest.mark.parametrize("n", [5, 400])
def test_against_sorting(spark, n):
    sources = ["b", "a", None, "é", "hot", "hot", "hot"]
    docs = [(i, brute.prose(i, 1 + i % 50), sources[i % 7]) for i in range(n)]
    mixed = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4))
    got = {(r["doc_id"], r["text"], r["source"]): r["copies"] for r in mixed.collect()}
    assert got == {k: c for k, (c, size) in plain(docs).items()} or all(
        got[k] == c or size == 0 for k, (c, size) in plain(docs).items()
    )


def test_taken_words_come_near_the_target(spark):
    docs = [(i, brute.prose(i, 30), f"s{i % 4}" if i % 3 else "hot") for i in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    narrow = mixing.sized(df)
    limits = {r["source"]: r for r in mixing.thresholds(narrow, mixing.targets(narrow)).collect()}
    taken = mixing.mix(df).selectExpr("source", "copies * 30 AS words").groupBy("source").sum("words").collect()
    for source, words in taken:
        assert abs(words - limits[source]["target"]) <= 30
        assert limits[source]["target"] <= 3 * limits[source]["source_size"]


def test_awkward_rows(spark):
    df = brute.awkward(spark)
    once, again = (sorted(map(str, mixing.mix(df.repartition(k)).collect())) for k in (2, 5))
    assert once == again and len(once) == df.count()
    assert set(mixing.mix(df).columns) == set(df.columns)  # copies takes the place of a column of its name
    assert mixing.mix(brute.empty(spark)).isEmpty()
