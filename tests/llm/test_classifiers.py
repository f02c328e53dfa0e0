import re
import time
from collections import Counter

import numpy as np
import pytest

import brute
from tidemark.llm import QUERIES, batches, quality, toxicity

SF_DIR = "/root/testdata/sf0.01"


def held_out(spark, name, label):
    found = QUERIES[name](spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").where("held_out").collect()
    return np.array([r["score"] for r in found]), np.array([r[label] for r in found]), np.array([r["predicted"] for r in found])


def area(score, label):
    above = (score[label == 1][:, None] > score[label == 0]).mean()
    return above + 0.5 * (score[label == 1][:, None] == score[label == 0]).mean()


def test_quality_on_held_out_documents(spark):
    score, label, predicted = held_out(spark, "op4_quality_scores", "quality")
    assert area(score, label) > 0.9
    assert predicted[label == 1].mean() > 0.97  # good documents are kept
    assert set(predicted) <= {0, 1} and ((score >= 0) & (score <= 1)).all()


def test_toxicity_on_held_out_documents(spark):
    """With some forty toxic documents to learn from."""
    score, label, _ = held_out(spark, "op1_toxicity_scores", "toxic")
    assert area(score, label) > 0.8


def test_quality_scores_do_not_depend_on_the_bound_of_the_sample(spark):
    """85 % good documents: texts that tell nothing keep those odds in a sample of as many of either label."""
    rng = np.random.default_rng(5)
    plain = lambda: rng.choice("an er on the sh ti or ou".split(), 12).tolist()
    good = np.arange(3000) % 20 < 17
    mark = np.where(rng.random(3000) < 0.6, np.where(good, "fine", "junk"), "so")
    docs = spark.createDataFrame([(i, " ".join([*plain(), mark[i]]), 50) for i in range(3000)], "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, int(good[i])) for i in range(3000)], "doc_id long, quality int")
    texts, lengths = [" ".join([*plain(), "so"]).encode() for _ in range(200)], np.full(200, np.log1p(50))
    every, few = (quality.fit(docs, labels, most=most).scores(texts, lengths) for most in (4000, 250))
    odds = [np.log(x / (1 - x)).mean() for x in (every, few)]
    assert abs(odds[0] - odds[1]) < 0.6, odds


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    machine = quality.Machine([], 0.3, rng.normal(size=9), rng.normal(size=(9, quality.FACTORS)))
    rows = quality.Rows(np.array([0, 4, 6]), np.array([0, 3, 5, 8, 2, 3]), rng.normal(size=6))
    raw, _ = machine.raw(rows)
    for i, (a, b) in enumerate([(0, 4), (4, 6)]):
        x = [(rows.feature[j], rows.value[j]) for j in range(a, b)]
        pairs = sum(machine.factors[f] @ machine.factors[g] * v * w for n, (f, v) in enumerate(x) for g, w in x[n + 1 :])
        assert np.isclose(raw[i], 0.3 + sum(machine.weights[f] * v for f, v in x) + pairs)


def test_gradients_of_the_network():
    """Against finite differences, with windows of different lengths."""
    network = toxicity.Network.fresh()
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    rng = np.random.default_rng(2)
    inputs = rng.normal(size=(7, 2 * toxicity.DIM))
    ids = rng.integers(0, 7, (3, 5))
    mask = np.array([[1, 1, 1, 1, 1], [1, 1, 0, 0, 0], [1, 1, 1, 1, 0]], dtype=float)
    label, weight = np.array([1.0, 0, 1]), np.full(3, 1 / 3)
    loss, grads, d_inputs = network.gradients(inputs, ids, mask, label, weight)
    for name in ("wf", "uf", "bb", "ub", "attend", "out", "bias"):
        flat, g = network.p[name].reshape(-1), grads[name].reshape(-1)
        for i in rng.choice(len(flat), min(4, len(flat)), replace=False):
            kept, eps = flat[i], 1e-2
            flat[i] = kept + eps
            up = network.gradients(inputs, ids, mask, label, weight)[0]
            flat[i] = kept - eps
            down = network.gradients(inputs, ids, mask, label, weight)[0]
            flat[i] = kept
            assert np.isclose((up - down) / (2 * eps), g[i], atol=2e-3), name


def test_sums_of_rows_are_those_of_the_plain_way_in_less_time():
    """To the bit, since training repeats whatever rounding differs; with rows as they are, and shared by several indices."""

    def plain(index, rows, size):
        out = np.zeros((size, rows.shape[1]), np.float32)
        order = np.argsort(index, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(index[order]) != 0))
        out[index[order][first]] = np.add.reduceat(rows[order], first, axis=0)
        return out

    def seconds(run):
        took = []
        for _ in range(7):
            began = time.process_time()
            run()
            took.append(time.process_time() - began)
        return min(took)

    rng = np.random.default_rng(8)
    for n, width, size in ((45_000, 12, 1 << 13), (500, 24, 1 << 17), (1, 3, 2)):
        index = (size * rng.random(n) ** 3).astype(np.int64)
        rows, own = rng.normal(size=(n, width)).astype(np.float32), rng.integers(0, max(1, n // 9), n)
        assert np.array_equal(toxicity._sums(index, rows, size), plain(index, rows, size))
        assert np.array_equal(toxicity._sums(index, rows, size, own), plain(index, rows[own], size))
        if n == 45_000:
            assert seconds(lambda: toxicity._sums(index, rows, size, own)) < 0.8 * seconds(lambda: plain(index, rows[own], size))
    assert not toxicity._sums(np.zeros(0, np.int64), np.zeros((0, 2), np.float32), 3).any()


def test_all_windows_are_scored():
    first = np.array([0, 0, 10, 10 + 32, 42 + 33, 75 + 100])
    text, start, end = toxicity.windows_of(first)
    assert set(text) == set(range(5))
    for i in range(5):
        own = text == i
        covered = set().union(*(range(a, b) for a, b in zip(start[own], end[own])))
        assert covered == set(range(first[i], first[i + 1]))
    assert (end - start <= toxicity.WINDOW).all()


def test_training_sees_all_windows_of_long_documents(spark, monkeypatch):
    """Passages of 20 toxic words in texts of 200 windows; then clean and toxic texts of 1,250 windows."""
    rng = np.random.default_rng(6)
    clean = lambda n: rng.choice("an er on the sh ti or ou ing ble ha re st nd".split(), n).tolist()
    def text(n, toxic):
        words, at = clean(n), rng.integers(0, n - 20)
        if toxic:
            words[at : at + 20] = rng.choice(["vile", "scum", "filth"], 20)
        return " ".join(words)

    sizes = [3200 if i % 10 < 2 else 40 for i in range(200)]
    docs = spark.createDataFrame([(i, text(n, i % 2)) for i, n in enumerate(sizes)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    trained, train = [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda texts, *rest: trained.extend(texts) or train(texts, *rest))
    network = toxicity.fit(docs, labels)
    assert {len(windows) for windows in trained} == {2, 199}
    scores = network.scores([text(20_000, i % 2).encode() for i in range(8)])
    assert (scores[0::2] < 0.5).all() and (scores[1::2] > 0.5).all(), scores
    trained.clear()
    monkeypatch.setattr(toxicity, "MOST_WINDOWS", 500)  # fewer documents, none of them cut
    toxicity.fit(docs, labels)
    assert {len(windows) for windows in trained} == {2, 199} and 1000 <= sum(map(len, trained)) < 1400


def test_scores_do_not_depend_on_the_batch():
    texts = [brute.prose(i, 5 + 20 * i).encode() for i in range(12)] + [b"", "É é".encode()]
    labels = np.array([i % 2 for i in range(14)])
    network = toxicity.train([[t] for t in texts], labels)
    together = network.scores(texts)
    assert np.allclose(together, np.concatenate([network.scores([t]) for t in texts]), atol=1e-4)
    words = batches.Words(texts)
    stats = quality.structure(texts, np.zeros(14), words)
    rows = quality.vectors(words, stats, [])
    each = [(rows.feature[a:b], rows.value[a:b]) for a, b in zip(rows.first, rows.first[1:])]
    machine = quality.train(each, stats, labels.astype(float))
    together = machine.scores(texts, np.zeros(14))
    assert np.allclose(together, np.concatenate([machine.scores([t], np.zeros(1)) for t in texts]))


def tokens(text):
    """Words of letters, digits and what is beyond ASCII; A-Z and accented Latin capitals in lower case."""
    folded = "".join(c.lower() if c.isascii() or "À" <= c <= "Þ" and c != "×" else c for c in text)
    return [w.encode() for w in re.findall(r"[0-9a-z\x80-\U0010ffff]+", folded)]


def mixed(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ x >> shift) * factor % 2**64
    return x


def hashed(word):
    return sum((b + 1) * pow(batches._PRIME, i, 2**64) for i, b in enumerate(word)) % 2**64


def plain_toxicity(network, text):
    """Token by token over every window, one at a time."""
    p = {k: v.astype(float) for k, v in network.p.items()}
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def inputs(word):
        grams = [mixed((hashed(word[i : i + n]) + n) % 2**64) for n in (3, 4, 5) for i in range(len(word) - n + 1)]
        grams += [mixed((hashed(word[:n]) + 100 + n) % 2**64) for n in (1, 4, 5, 6) if len(word) >= n]
        own = p["word"][mixed(hashed(word)) >> 64 - toxicity.WORD_BITS]
        return np.concatenate([own, np.mean([p["char"][g >> 64 - toxicity.CHAR_BITS] for g in grams], axis=0)])

    def layer(xs, way):
        h, out = np.zeros(toxicity.HIDDEN), []
        for x in xs:
            xr, xz, xn = np.split(x @ p[f"w{way}"] + p[f"b{way}"], 3)
            ur, uz, un = np.split(h @ p[f"u{way}"], 3)
            z, new = sigmoid(xz + uz), np.tanh(xn + sigmoid(xr + ur) * un)
            h = z * h + (1 - z) * new
            out.append(h)
        return out

    def logit(words):
        if not words:
            return p["bias"][0]  # no states to pool
        xs = [inputs(w) for w in words]
        states = np.array([np.concatenate(s) for s in zip(layer(xs, "f"), layer(xs[::-1], "b")[::-1])])
        weight = np.exp(states @ p["attend"])
        return (weight / weight.sum()) @ states @ p["out"] + p["bias"][0]

    words, start, logits = tokens(text), 0, []
    while True:
        logits.append(logit(words[start : start + toxicity.WINDOW]))
        if start + toxicity.WINDOW >= len(words):
            return sigmoid(network.scale * max(logits) + network.shift)
        start += toxicity.STRIDE


def plain_quality(machine, text, length):
    """Every pair of features, of one text."""
    data, words = text.encode(), tokens(text)
    kinds = np.zeros(quality.KINDS)
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    for b in data:
        c = chr(b)
        kinds[0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3 if b == 32 else 4 if b in (10, 13)
              else 5 if b >= 128 else 7 + marks.index(b) if b in marks else 6] += 1
    lines, n, size = [x for x in data.split(b"\n") if x], len(words), max(1, len(data))
    stats = [*kinds / size, np.log1p(n), len(set(words)) / max(1, n), max(Counter(words).values(), default=0) / max(1, n),
             sum(map(len, words)) / max(1, n), len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)), size / max(1, len(lines)), length]
    values = {b: 1 + np.log(k) for b, k in Counter(mixed(hashed(w)) >> 64 - quality.WORD_BITS for w in words).items()}
    norm = np.sqrt(sum(v * v for v in values.values()))
    features, offset = [(b, v / norm) for b, v in values.items()], 1 << quality.WORD_BITS
    for edge, x in zip(machine.edges, stats):
        features.append((offset + sum(e < x for e in edge), quality.BIN_VALUE))
        offset += len(edge) + 1
    raw = machine.bias + sum(machine.weights[f] * v for f, v in features)
    raw += sum(machine.factors[f] @ machine.factors[g] * v * w for i, (f, v) in enumerate(features) for g, w in features[i + 1 :])
    return 1 / (1 + np.exp(-raw))


def test_whole_queries_against_plain_forward_passes(spark, monkeypatch):
    """The scores that op1 and op4 return, with the network (trained briefly) and the machine that they trained."""
    trained = {}
    monkeypatch.setattr(toxicity, "ROUNDS", 1)
    monkeypatch.setattr(toxicity, "LEAST_STEPS", 10)
    for module, name in ((toxicity, "op1_toxicity_scores"), (quality, "op4_quality_scores")):
        fit = module.fit
        monkeypatch.setattr(module, "fit", lambda *a, fit=fit, name=name: trained.setdefault(name, fit(*a)))
    small = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = {n: {r["doc_id"]: r["score"] for r in QUERIES[n](spark, small).collect()} for n in ("op1_toxicity_scores", "op4_quality_scores")}
    assert all(scores.keys() == docs.keys() for scores in found.values())
    some = sorted(docs)[::25]  # the plain passes take long
    for i in some:
        text = docs[i]["text"] or ""
        n = docs[i]["n_chars"]
        assert np.isclose(found["op1_toxicity_scores"][i], plain_toxicity(trained["op1_toxicity_scores"], text), atol=1e-3)
        assert np.isclose(found["op4_quality_scores"][i], plain_quality(trained["op4_quality_scores"], text, -1.0 if n is None else np.log1p(max(n, 0))))


@pytest.mark.parametrize("text", ["", " \n", "a", "É é x×y ÀB-c\nd", brute.prose(4, 33), brute.prose(5, 100) + " !! 12\n\nx"])
def test_awkward_texts_against_plain_forward_passes(text):
    rng = np.random.default_rng(3)
    network = toxicity.Network.fresh()
    network.scale, network.shift = 1.7, 0.2
    assert np.isclose(network.scores([text.encode()])[0], plain_toxicity(network, text), atol=1e-4)
    edges = [np.unique(rng.random(3)) for _ in range(quality.KINDS + 8)]
    size = (1 << quality.WORD_BITS) + sum(len(e) + 1 for e in edges)
    machine = quality.Machine(edges, 0.1, rng.normal(0, 0.1, size), rng.normal(0, 0.1, (size, quality.FACTORS)))
    assert np.isclose(machine.scores([text.encode()], np.array([1.5]))[0], plain_quality(machine, text, 1.5))


@pytest.mark.parametrize("labels", [[], [1], [0, 0]])
def test_without_both_labels(spark, labels):
    docs = brute.awkward(spark)
    known = spark.createDataFrame([(i + 1, x, x) for i, x in enumerate(labels)], "doc_id long, quality int, toxic int")
    machine, network = quality.fit(docs, known), toxicity.fit(docs, known)
    for found in (quality.score(docs, machine, keep=["doc_id"]), toxicity.score(docs, network, keep=["doc_id"])):
        assert found.count() == docs.count() and len({r["score"] for r in found.collect()}) == 1
    kept = quality.kept(docs, machine, 0.3)
    assert kept.columns == docs.columns


def test_word_hashes_are_those_of_the_folded_word():
    texts = ["The THE the", "Éa éa ÉA x×y", "", "a-b c"]
    words = batches.Words([t.encode() for t in texts])
    by_doc = [words.hash[words.doc == i].tolist() for i in range(4)]
    assert len(set(by_doc[0])) == 1 and len(set(by_doc[1][:3])) == 1 and len(by_doc[2]) == 0 and len(by_doc[3]) == 3
    spaced = batches.Words(["É é a,b".encode()], by_space=True)
    assert len(spaced.hash) == 3 and spaced.hash[0] != spaced.hash[1]
