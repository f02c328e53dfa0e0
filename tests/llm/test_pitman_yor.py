import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import brute
from tidemark.llm import pitman_yor as py

SF_DIR = "/root/testdata/sf0.001"


def test_counts_base_scores_and_gain(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: brute.words(r["text"]) + [None] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, ws in texts.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    gain = {True: 0.0, False: 0.0}
    for r in py.score(docs).collect():
        ws = texts[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        gain[held[r["doc_id"]]] += r["score"] - r["base_score"]
    assert gain[True] > 0 and gain[False] > 0


def hashed(*words):
    return py.batches.Words([w.encode() for w in words], by_space=True).hash.view(np.int64)


def trained(spark, texts):
    """The rows of the buckets as dictionaries, and the model."""
    rows, model = py.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    return [r.asDict() for r in rows.collect()], model


def plain_probability(rows, model, word, context):
    """The predictive rule word by word: each sample's context restaurant over its root, averaged."""
    out = []
    for s in range(py.SAMPLES):
        customers = tables = root_customers = root_tables = 0
        for row in rows:
            r = py.Row.of(row)
            where = np.flatnonzero(r.words == word)
            if not len(where):
                continue
            i = where[0]
            root_customers = np.frombuffer(row["root_customers"]).reshape(py.SAMPLES, -1)[s, i]
            root_tables = np.frombuffer(row["root_tables"]).reshape(py.SAMPLES, -1)[s, i]
            several = np.frombuffer(row["samples"], "<u4").reshape(py.SAMPLES, -1)[s].tolist()
            for w, c, n in zip(r.word, r.context, r.customers):
                t = several.pop(0) if n > 1 else 1
                if (w, c) == (i, context):
                    customers, tables = n, t
        known, root_total, root_all = model.known, model.customers[s, -1], model.tables[s, -1]
        root = (root_customers - model.discount * root_tables + (py.ROOT_STRENGTH + model.discount * root_all) / (known + 1)) / (py.ROOT_STRENGTH + root_total)
        whole, all_ = model.customers[s, context], model.tables[s, context]
        out.append((customers - py.DISCOUNT * tables + (py.STRENGTH + py.DISCOUNT * all_) * root) / (py.STRENGTH + whole))
    return np.mean(out)


@pytest.mark.parametrize("bucket_tokens", [1 << 18, 60])
def test_probabilities_add_up_to_one_and_follow_the_rule(spark, monkeypatch, bucket_tokens):
    """Over all known words and one unknown, in each context; also with common words counted in copies."""
    monkeypatch.setattr(py, "BUCKET_TOKENS", bucket_tokens)
    texts = ["the " + " the ".join(brute.prose(i, 30).split()) for i in range(12)]
    rows, model = trained(spark, texts)
    assert (len(model.common) > 0) == (bucket_tokens < 1000 or model.buckets < 40)
    assert sum(len(py.Row.of(r).words) for r in rows) == model.known == len({w for t in texts for w in t.split()}) + 1
    draw = np.random.default_rng(1)
    for context in [0, 1, model.restaurants - 1, int(np.searchsorted(model.contexts, hashed("the")[0]))]:
        total = 0
        for row in rows:
            of, counts = py.probabilities(row, model)
            each = of(np.arange(len(counts)), np.full(len(counts), context))
            total += each.sum()
            i = draw.integers(len(counts))
            assert math.isclose(each[i], plain_probability(rows, model, py.Row.of(row).words[i], context), rel_tol=1e-9)
        zero = np.zeros(1)
        unknown = np.mean([model.context(zero, zero, np.array([context]), model.root(zero, zero, s), s) for s in range(py.SAMPLES)])
        assert math.isclose(total + unknown, 1, rel_tol=1e-6)
        assert math.isclose(unknown, plain_probability(rows, model, -5, context), rel_tol=1e-9)


def test_pairs_are_counted_in_full(spark, monkeypatch):
    """Every pair of neighbours, also where common words are merged in two steps."""
    monkeypatch.setattr(py, "BUCKET_TOKENS", 100)
    texts = [("a b a c " * (i + 1) + brute.prose(i, 20)).strip() for i in range(40)] + [None, ""]
    rows, model = trained(spark, texts)
    assert len(model.common)
    expected = Counter()
    for t in texts:
        ws = brute.words(t)
        expected.update(zip([None, *ws], [*ws, None]))
    names = {int(h): w for w in {w for t in texts for w in brute.words(t)} for h in hashed(w)} | {py.END: None}
    contexts = [names[int(h)] for h in model.contexts]
    found = Counter()
    for row in rows:
        r = py.Row.of(row)
        for w, c, n in zip(r.word, r.context, r.customers):
            found[None if c > len(contexts) else contexts[c], names[int(r.words[w])]] += int(n)
    assert found == expected
    assert np.allclose(model.customers[0, :-1].sum(), sum(expected.values()))


def chain(seed, n, words):
    """Words of which one successor is 95 % certain."""
    draw = np.random.default_rng(seed)
    follow, at, out = np.random.default_rng(9).permutation(words), 0, []
    for _ in range(n):
        at = follow[at] if draw.random() < 0.95 else draw.integers(words)
        out.append(f"w{at}")
    return " ".join(out)


def test_certain_successors_are_learned(spark):
    """Two thirds of the way from single words to the chain itself, on held-out texts."""
    df = spark.createDataFrame([(i, chain(i, 400, 300)) for i in range(150)], "doc_id long, text string")
    found = [r for r in py.score(df).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2]
    tokens = sum(r["n_tokens"] for r in found)
    base, score = (sum(r[c] for r in found) / tokens for c in ("base_score", "score"))
    itself = 0.95 * math.log10(0.95 + 0.05 / 300) + 0.05 * math.log10(0.05 / 300)
    assert (score - base) / (itself - base) > 0.667


def test_scores_do_not_depend_on_files(spark, tmp_path):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    scores = []
    for files in (1, 6):
        df.repartition(files, "doc_id").write.parquet(f"{tmp_path}/{files}")
        scores.append({r["doc_id"]: r["score"] for r in py.score(spark.read.parquet(f"{tmp_path}/{files}")).collect()})
    assert scores[0].keys() == scores[1].keys()
    assert all(math.isclose(scores[0][i], scores[1][i], rel_tol=1e-9) for i in scores[0])


def test_moves_keep_the_exact_distribution():
    """Tables of four customers of a word, against all ways to seat them."""
    d, new, n, cells = py.DISCOUNT, 0.8, 4, 4000

    def partitions(k):
        if k == 0:
            yield []
            return
        for p in partitions(k - 1):
            yield [*p, 1]
            for i in range(len(p)):
                yield [*p[:i], p[i] + 1, *p[i + 1 :]]

    weight = Counter()
    for sizes in partitions(n):
        product = 1.0
        for t in range(len(sizes)):
            product *= (py.STRENGTH + d * (2 + t)) * new
        for size in sizes:
            for j in range(1, size):
                product *= j - d
        weight[len(sizes)] += product
    rng = np.random.default_rng(5)
    customers = np.full(cells, n)
    seating = py.Seating.of(customers, np.full(cells, n), np.ones(cells, np.int64), 60)
    for _ in range(60):
        change = seating.move(lambda now, _: (py.STRENGTH + d * (2 + now)) * new, rng)
        assert (np.abs(change) <= 1).all()
    assert np.array_equal(np.add.reduceat(seating.size, seating.begin), customers)
    assert np.array_equal(np.add.reduceat((seating.size > 0).astype(int), seating.begin), seating.tables)
    whole = sum(weight.values())
    for t in range(1, n + 1):
        assert abs((seating.tables == t).mean() - weight[t] / whole) < 0.04


def test_a_sweep_seats_all_customers_again(spark, monkeypatch):
    """Whatever the first seating, a turn leaves the tables of a pair of 6,000 customers where their distribution is: it used to
    move a few customers only, and left those at tables of their own (or at one) there."""
    texts = spark.createDataFrame([(" ".join(["a b"] * 1000 + [f"c{i}x{j}" for j in range(700)]),) for i in range(6)], "text string")
    found = []
    for first in (lambda n: np.minimum(n, 1), lambda n: n):
        monkeypatch.setattr(py, "seat", lambda customers, *_, first=first: first(customers).astype(float))
        model = py.Model.of(py.word_counts(texts))
        rows = py.vocabulary(texts, model)
        model = py.totals(rows, model, 1, started=False)
        for row in py.swept(rows, model, 0).collect():
            r = py.Row.of(row)
            many = r.customers > 1
            found += [t for n, t in zip(r.customers[many], np.frombuffer(row["tables"], "<u4")) if n >= 5000]
    assert len(found) == 4 and max(found) < 400, found  # a b and b a, twice


def test_tables_are_drawn_from_the_exact_distribution():
    """Against the recursion of Stirling numbers, listed or proposed, and against many moves of one customer."""
    rng = np.random.default_rng(7)
    ways = py._ways(900)
    for n in (600, 900):
        t = np.arange(1.0, n + 1)
        assert np.abs(py._ways_of_many(np.full(n, float(n)), t) - ways[n, 1 : n + 1]).max() < 1e-6
    for n, a, c, d, e in ((3, 4.0, 1.0, 0.5, 9.0), (40, 300.0, 20, 0.9, 1000), (600, 5.0, 20, 0.3, 1000), (900, 3000.0, 1e5, 0.9, 1e6), (900, 1e7, 5e5, 0.6, 5e5)):
        k = np.arange(1, n)
        log = np.concatenate(([0], np.cumsum(np.log((a + py.DISCOUNT * k) * (c + d * k) / (e + k))))) + ways[n, 1 : n + 1]
        exact = np.exp(log - log.max())
        exact /= exact.sum()
        mean = exact @ np.arange(1, n + 1)
        spread = np.sqrt(exact @ (np.arange(1, n + 1) - mean) ** 2)
        cells = np.full(3000, n)
        given = tuple(np.full(3000, x) for x in (a, py.DISCOUNT, c, d, e))
        tables = np.rint(np.clip(mean, 1, n)) * np.ones(3000, np.int64)
        for _ in range(3):
            tables = py.seat_again(cells, tables, given, py._ways(512), rng).astype(np.int64)
        assert tables.min() >= 1 and tables.max() <= n
        assert abs(tables.mean() - mean) < 0.1 * spread + 1e-3 and abs(tables.std() - spread) < 0.15 * spread + 0.01
    n, cells = 9, 3000
    seating = py.Seating.of(np.full(cells, n), np.full(cells, n), np.ones(cells, np.int64), 200)
    for _ in range(200):
        seating.move(lambda now, _: (7.0 + py.DISCOUNT * now) * (1.0 + 0.1 * now) / (9.0 + now), rng)
    given = tuple(np.full(cells, x) for x in (7.0, py.DISCOUNT, 1.0, 0.1, 9.0))
    drawn = py.seat_again(np.full(cells, n), np.ones(cells, np.int64), given, ways, rng)
    for t in range(1, n + 1):
        assert abs((seating.tables == t).mean() - (drawn == t).mean()) < 0.05


def test_first_sizes_fit(spark):
    rng = np.random.default_rng(6)
    customers = np.array([2, 2, 9, 1000, 5])
    tables = np.array([1, 2, 4, 37, 5])
    sizes = py.Seating.first(customers, tables, rng)
    assert np.array_equal(np.add.reduceat(sizes, np.cumsum(tables) - tables), customers) and sizes.min() >= 1
    seating = py.Seating.of(customers, sizes, tables, 3)
    assert np.array_equal(seating.packed(), sizes)


def test_seating_follows_the_restaurant():
    """Mean tables of one dish against a simulation, one at a time and in runs."""
    rng = np.random.default_rng(4)
    for n in (5, 40, 1000):
        customers, base, others = np.full(400, n), np.full(400, 0.2), np.full(400, 3.0)
        mean = py.seat(customers, base, others, 0.5, 1.0, rng).mean()
        plain = []
        for _ in range(400):
            t = 1
            for j in range(2, n + 1):
                opens = (1.0 + 0.5 * (3.0 + t)) * 0.2
                t += rng.random() * (opens + j - 1 - 0.5 * t) < opens
            plain.append(t)
        assert abs(mean - np.mean(plain)) < 0.15 * np.mean(plain) + 0.05


def test_contexts():
    contexts = np.sort(hashed("the", "of"))
    name = {w: int(np.searchsorted(contexts, hashed(w)[0])) for w in ("the", "of")}
    tokens = py.Tokens.of([b"a the b", b"", b"of", b"The of the"], contexts)
    t, o, other, start = name["the"], name["of"], 2, 3
    assert tokens.context.tolist() == [start, other, t, start, start, t, o, other, start, o, t]
    assert tokens.doc.tolist() == [0, 0, 0, 2, 3, 3, 3, 0, 1, 2, 3]


def test_many_repeats_and_repeated_ids(spark):
    docs = [(1, "a " * 1000 + "b"), (1, "a"), (1, "a"), (3, None), (None, "")]
    found = py.score(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    assert sorted(r["n_tokens"] for r in found) == [1, 1, 2, 2, 1002]
    assert len({r["score"] for r in found if r["n_tokens"] == 2}) == 1
    assert all(r["score"] < 0 for r in found)


def test_without_training_texts(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    found = py.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (found["n_known"], found["train_tokens"], found["base_score"], found["score"]) == (0, 0, 0.0, 0.0)


def test_successors_of_rare_words_are_learned(spark, monkeypatch):
    """Rare words have restaurants of their own, rare successors too: nearly as much is learned as when all are frequent."""
    df = spark.createDataFrame([(i, chain(i, 400, 300)) for i in range(150)], "doc_id long, text string")
    gains = []
    for share in (py.CONTEXT_SHARE, 0.0033, 0.02):
        monkeypatch.setattr(py, "CONTEXT_SHARE", share)
        found = [r for r in py.score(df).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2]
        gains.append(sum(r["score"] - r["base_score"] for r in found) / sum(r["n_tokens"] for r in found))
    assert gains[0] > 1 and all(abs(g / gains[0] - 1) < 0.01 for g in gains), gains


@pytest.mark.parametrize("bucket_tokens", [1 << 18, 100])
def test_pairs_of_rare_words_are_counted_in_full(spark, monkeypatch, bucket_tokens):
    """By word after frequent words and by context after rare ones; of held-out texts, pairs of rare words without a customer. All
    training words have a row."""
    monkeypatch.setattr(py, "BUCKET_TOKENS", bucket_tokens)
    monkeypatch.setattr(py, "CONTEXT_SHARE", 0.01)
    texts = [("a b a c " * (i + 1) + "x y " * 3 + brute.prose(i, 20) + f" only{i} common" * 9).strip() for i in range(40)]
    held = ["x y new words a new c", None]
    df = spark.createDataFrame([(t, False) for t in texts] + [(t, True) for t in held], "text string, held boolean").repartition(3)
    rows, contexts, model = py.trained(df)
    words = [brute.words(t) for t in texts]
    count = Counter(w for ws in words for w in [*ws, None])
    known = {None if w is None else w: py.END if w is None else int(hashed(w)[0]) for w in {*count, *brute.words(held[0])}}
    names = {h: w for w, h in known.items()}
    expected, found, parts = Counter(), Counter(), []
    for ws in words:
        expected.update(zip([0, *ws], [*ws, None]))
    for row in rows.collect():
        r = py.Row.of(row.asDict())
        parts += r.words.tolist()
        for w, c, n in zip(r.word, r.context, r.customers):
            found[0 if c > len(model.contexts) else names[int(model.contexts[c])], names[int(r.words[w])]] += int(n)
    assert Counter(parts) == Counter(known[w] for w in count)
    nobody = set()
    for row in contexts.collect():
        r = py.Row.of(row.asDict())
        rare, more = (np.frombuffer(row[c], "<i8").tolist() for c in ("rare", "more"))
        for u, c, n in zip(r.word, r.context, r.customers):
            w = names[rare.pop(0) if c == py._RARE else int(model.words[c])]
            if c == py._RARE:
                assert more.pop(0) == count[w]
            found[names[int(r.words[u])], w] += int(n)
            if not n:
                nobody.add((names[int(r.words[u])], w))
    assert found == expected and sum(expected.values()) == model.trained
    assert nobody == {("new", "words")}
    assert any(w not in count or count[w] < 0.01 * model.trained for w in count) and len(model.contexts) < 10


def test_probabilities_after_rare_words(spark, monkeypatch):
    """They follow the rule, with the root's customers from all contexts, and add up to one."""
    monkeypatch.setattr(py, "CONTEXT_SHARE", 0.02)
    texts = [("a b a c " * (i + 1) + "x y " * 3 + brute.prose(i, 20) + " only common" * 9).strip() for i in range(40)]
    df = spark.createDataFrame([(t, False) for t in texts] + [("x z x of", True)], "text string, held boolean").repartition(3)
    rows, contexts, model = py.trained(df)
    root: list[dict[int, float]] = [{} for _ in range(py.SAMPLES)]
    tables: Counter = Counter()
    for row in rows.collect():
        r = py.Row.of(row.asDict())
        each = [np.frombuffer(row[c], "<f8").reshape(py.SAMPLES, -1) for c in ("root_customers", "root_tables")]
        tables.update(dict(zip(r.words.tolist(), each[0][-1])))
        for s in range(py.SAMPLES):
            root[s] |= dict(zip(r.words.tolist(), model.root(each[0][s], each[1][s], s)))
    zero = np.zeros(1)
    unknown = [float(model.root(zero, zero, s)[0]) for s in range(py.SAMPLES)]
    assert len(root[0]) == model.known and all(math.isclose(sum(x.values()) + u, 1, rel_tol=1e-9) for x, u in zip(root, unknown))
    checked = 0
    for row in contexts.collect():
        r, several = py.Row.of(row.asDict()), np.frombuffer(row["samples"], "<u4").reshape(py.SAMPLES, -1)
        rare, at = np.frombuffer(row["rare"], "<i8").tolist(), np.cumsum(r.customers > 1) - 1
        partner = [rare.pop(0) if c == py._RARE else int(model.words[c]) for c in r.context]
        of = py.context_probabilities(row.asDict(), model)
        found, _ = of(r.word, r.context, np.array(partner))
        for u in range(len(r.words)):
            mine = np.flatnonzero(r.word == u)
            n = r.customers[mine]
            total, given = np.zeros(py.SAMPLES), {}
            for s in range(py.SAMPLES):
                t = np.where(n > 1, several[s][at[mine]] if several.shape[1] else 0, n)
                rest = py.STRENGTH + py.DISCOUNT * t.sum()
                own = {partner[i]: max(a - py.DISCOUNT * b, 0) for i, a, b in zip(mine, n, t)}
                each = {w: (own.get(w, 0) + rest * p) / (py.STRENGTH + n.sum()) for w, p in (root[s] | {0: unknown[s]}).items()}
                total[s] = sum(each.values())
                for i in mine:
                    given[i] = given.get(i, 0) + each.get(partner[i], each[0]) / py.SAMPLES
            assert np.allclose(total, 1, rtol=1e-9)
            assert all(math.isclose(found[i], p, rel_tol=1e-9) for i, p in given.items())
            checked += len(given)
    assert checked > 100
    x, z, never = hashed("x", "z", "never")
    for row in contexts.collect():
        r = py.Row.of(row.asDict())
        if x in r.words:
            assert x != z and z in np.frombuffer(row["rare"], "<i8")
    empty, count = py.context_probabilities(None, model)(np.array([-1, -1]), np.array([0, py._RARE]), np.array([0, never]))
    assert math.isclose(empty[0], np.mean([x[int(model.words[0])] for x in root]), rel_tol=1e-9)
    assert math.isclose(empty[1], np.mean(unknown), rel_tol=1e-9) and count.tolist() == [model.counts[0], 0]


def test_sweeps_and_samples_of_the_first_form():
    assert (py.TURNS, py.SWEEPS, py.SAMPLES) == (2, 4, 3)


def test_texts_of_a_task_are_packed_together(spark):
    """6 MB of texts are one part, with one row a bucket, not a part for each 1.5 MB; and their tokens are those of the texts one by one."""

    def parts(given):
        for number, part in py._numbered(given):
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([part.num_rows])], names=["number", "n"])

    texts = [(brute.prose(i, 30) + " ") * 12 for i in range(2500)]
    assert sum(map(len, texts)) > 4 * py._PART_BYTES // 2
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    assert [r["n"] for r in df.mapInArrow(parts, "number long, n long").collect()] == [2500]
    some = [t.encode() for t in [*texts[:40], "", "a"]]
    whole, pieces = py.Tokens.of(some, hashed("a")), None
    old, py._PART_BYTES = py._PART_BYTES, 1000
    try:
        pieces = py.Tokens.together(some, hashed("a"))
    finally:
        py._PART_BYTES = old
    each = [Counter(zip(t.hash.tolist(), t.doc.tolist(), np.where(t.before >= 0, t.hash[t.before], 0).tolist())) for t in (whole, pieces)]
    assert each[0] == each[1]
