"""Toxicity from a bidirectional gated recurrent network with attention pooling, in numpy.

A token's input is an embedding of the word (hashed) beside the mean embedding of its character
n-grams (hashed bytes: all of three to five, and the first four to six). Two gated recurrent layers read a
window of tokens in either direction, attention pools their states, and a logistic unit scores the
window. A text is scored by all its overlapping windows, the last one included however short: its
score is that of its worst window, calibrated on documents.

Training sees labels of documents only, so it alternates: score the windows of toxic documents, take
those for positive that stand out (each such document has at least one), train on. It is done on the
driver, on all windows of a bounded sample (at most ``most`` documents of each label, and no more of them once
they have ``MOST_WINDOWS`` windows; no document is cut), so the maxima that it is calibrated on are those of scoring. Scoring sends the trained numbers to the tasks, which work on Arrow batches; the gates'
share of the inputs is computed once for each distinct word of a batch part.

Defined results: null and empty texts have no tokens and are scored as one empty window; without labels
of both kinds every score is the share of label 1 (0.5 without any); equal rows get equal
scores; extra columns are ignored.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import batches
from .labelled import label_share, training_sample, with_scores

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(batches)

WINDOW, STRIDE = 32, 16
WORD_BITS, CHAR_BITS = 13, 13
DIM, HIDDEN = 12, 8
MOST_LABELLED = 1600
MOST_WINDOWS = 40_000  # of the documents of a label; the one that reaches it is the last
ROUNDS = 6
MOST_POSITIVE = 16_000  # windows in a round
LEAST_STEPS = 150  # gradient steps in a round
BATCH = 256
SEED = 5
_CHUNK = 1024  # windows that are scored at once
_PART_BYTES = 1 << 20  # of text that training reads at once


def inputs_of(words: batches.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words: for each token its number, for each number its word bucket, and the buckets of its
    character n-grams as (first, bucket) lists."""
    _, at, number = np.unique(words.hash, return_index=True, return_inverse=True)
    start, end = words.start[at], words.end[at]
    length = end - start
    owner, bucket = [], []
    for n in (3, 4, 5):
        count = np.maximum(length - n + 1, 0)
        own = np.repeat(np.arange(len(at)), count)
        offset = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
        begin = start[own] + offset
        owner.append(own)
        bucket.append(batches.mix64(words.span_hash(begin, begin + n) + np.uint64(n)))
    for n in (1, 4, 5, 6):
        own = np.flatnonzero(length >= n)
        owner.append(own)
        bucket.append(batches.mix64(words.span_hash(start[own], start[own] + n) + np.uint64(100 + n)))
    owner, bucket = np.concatenate(owner), np.concatenate(bucket) >> np.uint64(64 - CHAR_BITS)
    order = np.argsort(owner, kind="stable")
    first = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(at)))))
    word = (words.hash[at] >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    return number, word, first, bucket[order].astype(np.int64)


def inputs_of_windows(texts: list[list[bytes]]) -> tuple[np.ndarray, ...]:
    """What :func:`inputs_of` gives for all windows of some documents, and where the tokens of each window begin;
    read in parts of ``_PART_BYTES``, since the arrays of a part are many times its size."""
    windows = [w for doc in texts for w in doc]
    part = np.cumsum([len(w) + 1 for w in windows]) // _PART_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(windows)]
    hashes, numbers, words, sizes, buckets, lengths = [], [], [], [], [], []
    for a, b in zip(cuts, cuts[1:]):
        found = batches.Words(windows[a:b])
        number, word, first, bucket = inputs_of(found)
        for kept, x in zip(
            (hashes, numbers, words, sizes, buckets, lengths),
            (np.unique(found.hash), number, word, np.diff(first), bucket, np.diff(found.first)),
        ):
            kept.append(x)
    distinct, at = np.unique(np.concatenate(hashes), return_index=True)
    number = np.concatenate([np.searchsorted(distinct, h)[n] for h, n in zip(hashes, numbers)])
    size = np.concatenate(sizes)
    begin = (np.cumsum(size) - size)[at]
    first = np.concatenate(([0], np.cumsum(size[at])))
    own = np.arange(first[-1]) + np.repeat(begin - first[:-1], size[at])
    bounds = np.concatenate(([0], np.cumsum(np.concatenate(lengths))))
    return number, np.concatenate(words)[at], first, np.concatenate(buckets)[own], bounds


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first token, end) of all windows; a text without tokens has one empty window."""
    length = np.diff(first)
    count = np.maximum(1, -(-(length - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(length)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = first[:-1][text] + nth * STRIDE
    return text, start, np.minimum(start + WINDOW, first[1:][text])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _sums(index: np.ndarray, rows: np.ndarray, size: int, own: np.ndarray | None = None) -> np.ndarray:
    """The sum of the rows of each index; ``own`` gives the row of each index if they are not in order. Short numbers are
    sorted by their digits, and a column at a time is summed, both several times as fast as the plain way."""
    out = np.zeros((size, rows.shape[1]), np.float32)
    if len(index):
        short = index.astype(np.uint16) if size <= 1 << 16 else index
        order = np.argsort(short, kind="stable")
        ordered = short[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        out[ordered[first]] = _runs(rows, order if own is None else own[order], first)
    return out


def _runs(rows: np.ndarray, taken: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sums of runs of rows: those numbered ``taken``, in which the runs begin at ``first``."""
    columns = np.ascontiguousarray(rows.T)
    return np.stack([np.add.reduceat(c[taken], first) for c in columns], axis=1)


def _both_ways(windows: np.ndarray) -> np.ndarray:
    """The columns of ``windows`` in order, each beside that from the end."""
    turned = windows.T
    return np.stack([turned, turned[::-1]], axis=1)


@dataclass
class Network:
    p: dict[str, np.ndarray] = field(default_factory=dict)
    scale: float = 1.0
    shift: float = 0.0
    share: float | None = None  # the only answer of a network that could not be trained

    @staticmethod
    def fresh() -> "Network":
        rng = np.random.default_rng(SEED)
        draw = lambda *shape, by=0.1: rng.normal(0, by, shape).astype(np.float32)
        p = {"word": draw(1 << WORD_BITS, DIM), "char": draw(1 << CHAR_BITS, DIM, by=0.3)}
        for way in "fb":
            p[f"w{way}"], p[f"b{way}"] = draw(2 * DIM, 3 * HIDDEN, by=0.3), np.zeros(3 * HIDDEN, np.float32)
            p[f"u{way}"] = draw(HIDDEN, 3 * HIDDEN, by=0.3)
        p["attend"], p["out"], p["bias"] = draw(2 * HIDDEN, by=0.3), draw(2 * HIDDEN, by=0.3), np.full(1, -1.0, np.float32)
        return Network(p)

    def embed(self, word: np.ndarray, first: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Inputs of distinct words, each of which has at least one n-gram."""
        chars = _runs(self.p["char"], bucket, first[:-1]) if len(word) else np.zeros((0, DIM), np.float32)
        return np.concatenate([self.p["word"][word], chars / np.maximum(np.diff(first), 1)[:, None]], axis=1).astype(np.float32)

    def forward(self, gates: tuple[np.ndarray, ...], ids: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows (rows of ``ids``, numbers of words; ``mask`` is 0 on padding).

        ``gates`` holds, for either direction, the inputs' part of the gates by word number. Both directions are
        read at once: step t of one is beside step t from the end of the other."""
        n, steps = ids.shape
        states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        turned, inside = _both_ways(ids), _both_ways(mask)[:, :, :, None]
        x_gate, x_new = gates
        u = np.stack([self.p["uf"], self.p["ub"]])
        u_gate, u_new = np.ascontiguousarray(u[:, :, : 2 * HIDDEN]), np.ascontiguousarray(u[:, :, 2 * HIDDEN :])
        h = np.zeros((2, n, HIDDEN), np.float32)
        rows_gate, rows_new = (np.empty((2, n, x.shape[2]), x.dtype) for x in gates)
        for t in range(steps):
            rz, new = (np.empty_like(rows_gate), np.empty_like(rows_new)) if keep is not None else (rows_gate, rows_new)
            for way in (0, 1):
                np.take(x_gate[way], turned[t, way], axis=0, out=rz[way], mode="clip")
                np.take(x_new[way], turned[t, way], axis=0, out=new[way], mode="clip")
            rz += h @ u_gate
            np.negative(rz, out=rz)
            np.exp(rz, out=rz)
            rz += 1
            np.reciprocal(rz, out=rz)
            r, z = rz[:, :, :HIDDEN], rz[:, :, HIDDEN:]
            hu = h @ u_new
            new += r * hu
            np.tanh(new, out=new)
            if keep is not None:
                keep[t] = (h, r, z, new, hu)
            step = new - h
            step *= 1 - z
            step *= inside[t]
            h = h + step
            states[t, :, :HIDDEN], states[steps - 1 - t, :, HIDDEN:] = h
        score = states @ self.p["attend"] - 1e9 * (1 - mask.T)
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (states * weight[:, :, None]).sum(axis=0)
        if keep is not None:
            keep["states"], keep["weight"], keep["pooled"] = states, weight, pooled
        return pooled @ self.p["out"] + self.p["bias"][0]

    def gates(self, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The inputs' part of all gates, by direction, with one more row for padding: of those that sum and of the new state."""
        padded = np.concatenate([inputs, np.zeros((1, 2 * DIM), np.float32)])
        both = np.stack([padded @ self.p[f"w{way}"] + self.p[f"b{way}"] for way in "fb"])
        return np.ascontiguousarray(both[:, :, : 2 * HIDDEN]), np.ascontiguousarray(both[:, :, 2 * HIDDEN :])

    def gradients(self, inputs: np.ndarray, ids: np.ndarray, mask: np.ndarray, label: np.ndarray, weight: np.ndarray):
        """Loss, gradients of the parameters but the embeddings, and of the inputs by word number."""
        keep: dict = {}
        gates = self.gates(inputs)
        logit = self.forward(gates, ids, mask, keep)
        p = _sigmoid(np.clip(logit, -30, 30))
        loss = -(weight * (label * np.log(p + 1e-9) + (1 - label) * np.log(1 - p + 1e-9))).sum()
        d = (weight * (p - label)).astype(np.float32)
        g = {"out": d @ keep["pooled"], "bias": d.sum(keepdims=True)}
        d_pooled = d[:, None] * self.p["out"]
        states, attention = keep["states"], keep["weight"]
        d_weight = (states * d_pooled).sum(axis=2)
        d_score = attention * (d_weight - (attention * d_weight).sum(axis=0))
        g["attend"] = np.einsum("tn,tnh->h", d_score, states)
        d_states = attention[:, :, None] * d_pooled + d_score[:, :, None] * self.p["attend"]
        steps = ids.shape[1]
        d_inputs = np.zeros((len(inputs) + 1, 2 * DIM), np.float32)
        u = np.stack([self.p["uf"], self.p["ub"]])
        turned_u, inside = u.transpose(0, 2, 1), _both_ways(mask)[:, :, :, None]
        d_u = np.zeros_like(u)
        at_gates = np.empty((2, steps, len(ids), 3 * HIDDEN), np.float32)
        dh = np.zeros((2, len(ids), HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            back = steps - 1 - t
            h, r, z, new, hu = keep[t]
            dh = dh + np.stack([d_states[t, :, :HIDDEN], d_states[back, :, HIDDEN:]])
            m, rest = inside[t], 1 - z
            moved = m * dh
            a_new = moved * rest * (1 - new * new)
            a_z = -moved * (new - h) * z * rest
            a_r = a_new * hu * r * (1 - r)
            a = np.concatenate([a_r, a_z, a_new * r], axis=2)
            d_u += h.transpose(0, 2, 1) @ a
            for way, at in ((0, t), (1, back)):
                for part, x in enumerate((a_r, a_z, a_new)):
                    at_gates[way, at, :, part * HIDDEN : (part + 1) * HIDDEN] = x[way]
            dh = dh * (1 - m * rest) + a @ turned_u
        padded = np.concatenate([inputs, np.zeros((1, 2 * DIM), np.float32)])
        for number, way in enumerate("fb"):
            d_gates = _sums(ids.T.ravel(), at_gates[number].reshape(-1, 3 * HIDDEN), len(inputs) + 1)
            g[f"u{way}"] = d_u[number]
            g[f"w{way}"], g[f"b{way}"] = padded.T @ d_gates, d_gates.sum(axis=0)
            d_inputs += d_gates @ self.p[f"w{way}"].T
        return loss, g, d_inputs[:-1]

    def window_logits(self, inputs: np.ndarray, number: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        gates, padding = self.gates(inputs), len(inputs)
        number = np.append(number, padding)
        out = np.empty(len(start), np.float32)
        for a in range(0, len(start), _CHUNK):
            at = start[a : a + _CHUNK, None] + np.arange(WINDOW)
            inside = at < end[a : a + _CHUNK, None]
            ids = np.where(inside, number[np.minimum(at, len(number) - 1)], padding)
            out[a : a + _CHUNK] = self.forward(gates, ids, inside.astype(np.float32))
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """The probability that each text is toxic."""
        if self.share is not None or not texts:
            return np.full(len(texts), self.share if self.share is not None else 0.5)
        words = batches.Words(texts)
        number, *distinct = inputs_of(words)
        text, start, end = windows_of(words.first)
        logits = self.window_logits(self.embed(*distinct), number, start, end)
        worst = np.maximum.reduceat(logits, np.searchsorted(text, np.arange(len(texts)))).astype(float)
        return _sigmoid(np.clip(self.scale * worst + self.shift, -30, 30))


class _Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float) -> None:
        self.p, self.rate, self.steps = p, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.steps += 1
        correct = np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        for k, grad in g.items():
            self.m[k] += 0.1 * (grad - self.m[k])
            self.v[k] += 0.001 * (grad * grad - self.v[k])
            self.p[k] -= self.rate * correct * self.m[k] / (np.sqrt(self.v[k]) + 1e-7)


def train(texts: list[list[bytes]], labels: np.ndarray, share: float | None = None) -> Network:
    """Train on documents, each given as its windows' texts. ``share``: that of label 1 where the documents
    come from, if they are not a fair sample."""
    if len(set(labels.tolist())) < 2:
        return Network(share=float(labels.mean()) if len(labels) else 0.5)
    number, word, first, bucket, bounds = inputs_of_windows(texts)
    start = bounds[:-1]
    end = np.minimum(bounds[1:], start + WINDOW)
    doc = np.repeat(np.arange(len(texts)), [len(w) for w in texts])
    doc_first = np.searchsorted(doc, np.arange(len(texts)))
    toxic = labels[doc] == 1
    network, rng = Network.fresh(), np.random.default_rng(SEED)
    adam = _Adam(network.p, 0.015)
    padded = np.append(number, -1)
    chosen = np.ones(len(start), dtype=bool)
    for round_ in range(ROUNDS):
        if round_:
            logits = network.window_logits(network.embed(word, first, bucket), number, start, end)
            worst = np.maximum.reduceat(logits, doc_first)
            bar = np.quantile(logits[~toxic], 0.999)
            chosen = ~toxic | (logits >= np.maximum(bar, worst[doc] - 2.0)) | (logits == worst[doc])
        positive, negative = np.flatnonzero(chosen & toxic), np.flatnonzero(~toxic)
        if len(positive) > MOST_POSITIVE:  # in the first round, before the windows are told apart
            positive = rng.choice(positive, MOST_POSITIVE, replace=False)
        many = min(len(negative), max(3 * len(positive) if round_ else len(positive), 4000))
        for _ in range(max(1 if round_ == 0 else 2, -(-LEAST_STEPS * BATCH // max(1, many + len(positive))))):
            few = negative
            if many < len(negative):  # half of them those that look worst
                hard = negative[np.argsort(-logits[negative], kind="stable")[: many // 2]] if round_ else negative[:0]
                few = np.union1d(hard, rng.choice(negative, many - len(hard), replace=False))
            order = rng.permutation(np.concatenate([positive, few]))
            balance = len(few) / max(1, len(positive))
            for a in range(0, len(order), BATCH):
                part = order[a : a + BATCH]
                at = start[part, None] + np.arange(WINDOW)
                inside = at < end[part, None]
                ids = np.where(inside, padded[np.minimum(at, len(padded) - 1)], -1)
                used, local = np.unique(ids, return_inverse=True)
                local = local.reshape(ids.shape)
                if used[0] == -1:  # padding goes last
                    used, local = used[1:], np.where(local == 0, len(used) - 1, local - 1)
                size = first[used + 1] - first[used]
                used_first = np.concatenate(([0], np.cumsum(size)))
                grams = bucket[np.arange(used_first[-1]) + np.repeat(first[used] - used_first[:-1], size)]
                inputs = network.embed(word[used], used_first, grams)
                dropped = rng.random(len(used)) < 0.3  # the characters must do without the word
                inputs[dropped, :DIM] = 0
                label = labels[doc[part]].astype(np.float32)
                weight = np.where(label == 1, min(balance, 2.0), 1.0).astype(np.float32) / len(part)
                _, g, d_inputs = network.gradients(inputs, local, inside.astype(np.float32), label, weight)
                d_inputs[dropped, :DIM] = 0
                g["word"] = _sums(word[used], d_inputs[:, :DIM], 1 << WORD_BITS)
                each = d_inputs[:, DIM:] / np.maximum(size, 1)[:, None]
                g["char"] = _sums(grams, each, 1 << CHAR_BITS, np.repeat(np.arange(len(size)), size))
                adam.step(g)
    logits = network.window_logits(network.embed(word, first, bucket), number, start, end)
    network.scale, network.shift = _calibrated(
        np.maximum.reduceat(logits, doc_first).astype(float), labels.astype(float), labels.mean() if share is None else share
    )
    return network


def _calibrated(worst: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, float]:
    """Logistic regression of the labels on the worst windows, kept from growing without bound; documents are
    weighted so that label 1 has its ``share``."""
    center, spread = worst.mean(), worst.std() + 1e-6
    x, a, b = (worst - center) / spread, 1.0, 0.0
    weight = np.where(labels == 1, share / labels.sum(), (1 - share) / (1 - labels).sum())
    for _ in range(3000):
        error = (_sigmoid(np.clip(a * x + b, -30, 30)) - labels) * weight
        a, b = a - 2.0 * ((error * x).sum() + 0.002 * a), b - 2.0 * error.sum()
    return a / spread, b - a * center / spread


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", ident: str = "doc_id", text: str = "text", most: int = MOST_LABELLED) -> Network:
    """Train on all windows of at most ``most`` documents of each label that are not held out; of fewer, in the
    order of their hashes, if these have ``MOST_WINDOWS`` windows."""

    def run(parts):
        for batch in parts:
            for part in batches.slices(batch, text):
                words = batches.Words(batches.column_bytes(part.column(text)))
                owner, start, end = windows_of(words.first)
                bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
                windows = []
                for i in range(part.num_rows):
                    own = range(bounds[i], bounds[i + 1])
                    spans = [(words.start[start[w]], words.end[end[w] - 1]) for w in own if end[w] > start[w]]
                    windows.append([words.data[a:b].tobytes() for a, b in spans] or [b""])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("key", "label")),
                        pa.array([len(w) for w in windows], pa.int32()),
                        pa.array(windows, pa.list_(pa.binary())),
                    ],
                    names=["key", "label", "n", "windows"],
                )

    named = docs.select(F.col(ident), F.xxhash64(ident, text).alias("key"), F.col(text))
    sample = training_sample(named, labels, label, most, ident).select("key", "label", text)
    windows = materialize(sample.mapInArrow(run, "key long, label int, n int, windows array<binary>"), "toxicity-windows")
    counts = windows.select("key", "label", "n").collect()  # a row per document of the sample
    taken = F.lit(False)
    for value in (0, 1):
        own = sorted((r["key"], r["n"]) for r in counts if r["label"] == value)
        if own:
            before = np.cumsum([0] + [n for _, n in own[:-1]])
            last = own[int((before < MOST_WINDOWS).sum()) - 1][0]
            taken = taken | ((F.col("label") == value) & (F.col("key") <= last))
    found = sorted(windows.filter(taken).collect(), key=lambda r: r["key"])
    return train(
        [[bytes(w) for w in r["windows"]] for r in found],
        np.array([r["label"] for r in found]),
        label_share(labels, label, ident),
    )


def score(docs: DataFrame, network: Network, *, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs`` and the probability that a text is toxic."""
    return with_scores(docs, network.scores, keep=keep, text=text, name=name)
