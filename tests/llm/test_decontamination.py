import re
from collections import Counter

import brute
from tidemark.llm import decontamination as dc


def fold(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def shingles(ws):
    return [tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))] if ws else []


def best_similarity(text, item):
    ws, item = fold(text), fold(item)
    if not ws or not item:
        return 0.0
    if len(item) < 5:
        return float(any(ws[i : i + len(item)] == item for i in range(len(ws) - len(item) + 1)))
    wanted, size, best = Counter(shingles(item)), len(item), 0.0
    for i in range(max(1, len(ws) - size + 1)):
        own = Counter(shingles(ws[i : i + size])) if len(ws) >= 5 else Counter()
        both = sum((own & wanted).values())
        best = max(best, both / (sum(own.values()) + sum(wanted.values()) - both))
    return best


def tables(spark):
    items = [(i, brute.prose(100 + i, 12 + 5 * i)) for i in range(10)] + [(50, "three little words"), (51, None), (52, ""), (53, items_repeat())]
    docs = []
    for i in range(40):
        before, after = brute.prose(i, 30 + i), brute.prose(500 + i, 20)
        ws = items[i % 10][1].split()
        for cut in range(i // 10 * 2):  # from exact copies to ones that are too far
            ws[(cut * 13 + 5) % len(ws)] = "changed"
        docs.append((i, f"{before}. {' '.join(ws).upper()}, {after}"))
    docs += [(100, brute.prose(900, 400)), (101, None), (102, "Three  little\nWORDS"), (103, items[3][1]), (104, " ".join(items[4][1].split()[:-1])), (105, items_repeat()), (106, "short")]
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), docs, items


def items_repeat():
    return "again and again and again and again and again and once more"


def test_against_brute_force(spark):
    df, benchmark, docs, items = tables(spark)
    expected = {(d, i): s for d, t in docs for i, x in items if (s := best_similarity(t, x)) >= 0.8}
    assert 10 < len(expected) < 60 and any(s < 1 for s in expected.values())
    for part_bytes in (dc.PART_BYTES, 500):
        found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in dc.matches(df, benchmark, part_bytes=part_bytes).collect()}
        assert found.keys() == expected.keys()
        assert all(abs(found[k] - expected[k]) < 1e-9 for k in found)
        clean = dc.without_matches(df, benchmark, part_bytes=part_bytes)
        assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in expected}


def test_index_holds_all_within_the_radius():
    """Fingerprints that differ in up to 23 bits share a near block."""
    import numpy as np

    rng = np.random.default_rng(1)
    items = dc.Items([1], [brute.prose(1, 20).encode()])
    (sized,) = items.sized.values()
    for _ in range(500):
        flips = rng.choice(64, rng.integers(0, 24), replace=False)
        other = sized.prints ^ np.bitwise_or.reduce(np.left_shift(np.uint64(1), flips.astype(np.uint64)), initial=np.uint64(0))
        blocks = other.astype("<u8").view(np.uint8)
        assert any(sized.near[b][blocks[b], 0] for b in range(8))


def test_awkward_rows(spark):
    df = brute.awkward(spark)
    items = spark.createDataFrame([(1, brute.prose(2, 60)), (1, brute.prose(2, 60)), (None, "zz yy")], "item_id long, text string")
    assert {r["doc_id"] for r in dc.matches(df, items).collect()} == {1, 2, 3}
    clean = dc.without_matches(df, items)
    assert clean.columns == df.columns and clean.count() == df.count() - 3
    assert dc.matches(brute.empty(spark), items).isEmpty()
    assert dc.without_matches(df, items.limit(0)).count() == df.count()
