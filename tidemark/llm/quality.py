"""Quality scores from a factorisation machine over words, structure and metadata.

A text is a sparse vector: its words, hashed, by their counts (unit length together), and statistics of
its structure and its stated length, each as the quantile bin it falls into. The machine is
bias + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j, where the pairs cost linear time, since their
sum is half of (sum v_i x_i) ** 2 - sum (v_i x_i) ** 2 per factor. It is trained with numpy on the
driver, on a bounded sample (``most`` documents of each label, weighted so that both labels have their
shares of all training labels), and applied to Arrow batches.

Defined results: a null text is empty, and an empty text is scored by its structure; a null length is a
bin of its own; without labels of both kinds every score is the share of label 1 (0.5 without any);
equal rows get equal scores; extra columns are ignored.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import batches
from .labelled import label_share, training_sample, with_scores
from .text import private

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(batches)

WORD_BITS = 15
FACTORS = 8
MOST_LABELLED = 4000
#: Quantiles that part a statistic's bins; the outer ones catch what is rare.
BIN_EDGES = (0.005, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.995)
#: The weight of a bin beside a text's words, which have unit length together.
BIN_VALUE = 0.4
EPOCHS = 10
SEED = 11

#: Kinds of bytes: 0 lower case, 1 upper case, 2 digits, 3 space, 4 line end, 5 beyond ASCII, 6 other
#: control characters, and each punctuation mark for itself.
_KIND = np.full(256, 6, dtype=np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[32], _KIND[[10, 13]], _KIND[128:] = 0, 1, 2, 3, 4, 5
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
_KIND[_MARKS] = np.arange(7, 7 + len(_MARKS), dtype=np.uint8)
KINDS = 7 + len(_MARKS)


def structure(texts: list[bytes], lengths: np.ndarray, words: batches.Words) -> np.ndarray:
    """Statistics of each text, one row each: shares of byte kinds, words, repetition, lines, length."""
    n = len(texts)
    out = np.zeros((n, KINDS + 8))
    order = words.hash
    for i, text in enumerate(texts):
        kinds = np.bincount(_KIND[np.frombuffer(text, dtype=np.uint8)], minlength=KINDS)
        size = max(1, len(text))
        a, b = words.first[i], words.first[i + 1]
        own = np.sort(order[a:b])
        new = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if b > a else np.zeros(0, dtype=int)
        lines = [x for x in text.split(b"\n") if x]
        out[i, :KINDS] = kinds / size
        out[i, KINDS:] = (
            np.log1p(b - a),
            len(new) / max(1, b - a),
            np.diff(np.append(new, b - a)).max(initial=0) / max(1, b - a),
            (words.end[a:b] - words.start[a:b]).sum() / max(1, b - a),
            len(set(lines)) / max(1, len(lines)),
            np.log1p(len(lines)),
            size / max(1, len(lines)),
            lengths[i],
        )
    return out


@dataclass
class Rows:
    """Sparse rows: features and values of row i are at ``first[i]`` to ``first[i + 1]``."""

    first: np.ndarray
    feature: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1


def vectors(words: batches.Words, stats: np.ndarray, edges: list[np.ndarray]) -> Rows:
    n = len(stats)
    bucket = (words.hash >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    key, count = np.unique((words.doc << WORD_BITS) | bucket, return_counts=True)
    doc, value = key >> WORD_BITS, 1 + np.log(count)
    value /= np.sqrt(np.bincount(doc, weights=value * value, minlength=n))[doc]
    offset, bins = 1 << WORD_BITS, []
    for j, edge in enumerate(edges):
        bins.append(offset + np.searchsorted(edge, stats[:, j], side="left"))
        offset += len(edge) + 1
    per_doc = np.bincount(doc, minlength=n)
    first = np.concatenate(([0], np.cumsum(per_doc + len(edges))))
    feature, values = np.empty(first[-1], dtype=np.int64), np.empty(first[-1])
    is_word = np.ones(first[-1], dtype=bool)
    at = first[1:, None] - len(edges) + np.arange(len(edges))
    is_word[at.ravel()] = False
    feature[is_word], values[is_word] = key & ((1 << WORD_BITS) - 1), value
    if edges:
        feature[at.ravel()] = np.stack(bins, axis=1).ravel()
        values[at.ravel()] = BIN_VALUE
    return Rows(first, feature, values)


@dataclass
class Machine:
    edges: list[np.ndarray]
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the rows, and per factor the sums that gradients need."""
        at = rows.first[:-1]
        own = self.factors[rows.feature] * rows.value[:, None]
        sums = np.add.reduceat(own, at, axis=0)
        pairs = 0.5 * (sums**2 - np.add.reduceat(own**2, at, axis=0)).sum(axis=1)
        return self.bias + np.add.reduceat(self.weights[rows.feature] * rows.value, at) + pairs, sums

    def scores(self, texts: list[bytes], lengths: np.ndarray) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        if not self.edges:  # not trained
            return np.full(len(texts), 1 / (1 + np.exp(-self.bias)))
        words = batches.Words(texts)
        raw, _ = self.raw(vectors(words, structure(texts, lengths, words), self.edges))
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def _quantiles(values: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The distinct ``BIN_EDGES`` quantiles of weighted values; with equal weights the usual, interpolated ones."""
    order = np.argsort(values, kind="stable")
    at = np.cumsum(weight[order]) - 0.5 * weight[order]
    return np.unique(np.interp(BIN_EDGES, (at - at[0]) / (at[-1] - at[0]), values[order]))


def train(
    word_rows: list[tuple[np.ndarray, np.ndarray]], stats: np.ndarray, labels: np.ndarray, share: float | None = None
) -> Machine:
    """Fit by adaptive gradient steps on the logistic loss, in small batches. ``share``: that of label 1 where
    the documents come from, if they are not a fair sample; documents are weighted to have it."""
    if len(set(labels.tolist())) < 2:
        share = min(max(labels.mean() if len(labels) else 0.5, 1e-6), 1 - 1e-6)
        return Machine([], float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, FACTORS)))
    sampled = labels.mean()
    share = sampled if share is None else share
    weight = np.where(labels == 1, share / sampled, (1 - share) / (1 - sampled))
    edges = [_quantiles(stats[:, j], weight) for j in range(stats.shape[1])]
    size = (1 << WORD_BITS) + sum(len(e) + 1 for e in edges)
    rng = np.random.default_rng(SEED)
    machine = Machine(edges, float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.05, (size, FACTORS)))
    seen_w, seen_v = np.full(size, 1e-2), np.full((size, FACTORS), 1e-2)
    bin_of, offset = [], 1 << WORD_BITS
    for j, edge in enumerate(edges):
        bin_of.append(offset + np.searchsorted(edge, stats[:, j], side="left"))
        offset += len(edge) + 1
    bin_of = np.stack(bin_of, axis=1)
    bin_value = np.full(len(edges), BIN_VALUE)
    for epoch in range(EPOCHS):
        rate = 0.15 / (1 + 0.2 * epoch)
        order = rng.permutation(len(labels))
        for start in range(0, len(order), 64):
            batch = order[start : start + 64]
            features = [np.concatenate([word_rows[i][0], bin_of[i]]) for i in batch]
            first = np.concatenate(([0], np.cumsum([len(f) for f in features])))
            values = np.concatenate([x for i in batch for x in (word_rows[i][1], bin_value)])
            rows = Rows(first, np.concatenate(features), values)
            raw, sums = machine.raw(rows)
            error = weight[batch] * (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch])
            each = np.repeat(error / len(batch), np.diff(first)) * rows.value
            used, at = np.unique(rows.feature, return_inverse=True)
            grad_w = np.bincount(at, weights=each) + 1e-5 * machine.weights[used]
            pull = each[:, None] * (np.repeat(sums, np.diff(first), axis=0) - machine.factors[rows.feature] * rows.value[:, None])
            grad_v = np.zeros((len(used), FACTORS))
            np.add.at(grad_v, at, pull)
            grad_v += 1e-4 * machine.factors[used]
            seen_w[used] += grad_w**2
            seen_v[used] += grad_v**2
            machine.weights[used] -= rate * grad_w / np.sqrt(seen_w[used])
            machine.factors[used] -= rate * grad_v / np.sqrt(seen_v[used])
            machine.bias -= 0.05 * error.mean()
    return machine


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", ident: str = "doc_id", text: str = "text", length: str = "n_chars", most: int = MOST_LABELLED) -> Machine:
    """Train on at most ``most`` documents of each label that are not held out. Features are made where
    the texts are; the driver gets the vectors of the sample, as bytes, which take a fraction of lists of numbers."""

    def run(parts):
        for batch in parts:
            for part in batches.slices(batch, text):
                texts = batches.column_bytes(part.column(text))
                lengths = part.column(length).to_numpy(zero_copy_only=False)
                words = batches.Words(texts)
                stats = structure(texts, lengths, words)
                rows = vectors(words, stats, [])
                spans = list(zip(rows.first[:-1], rows.first[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        part.column("label"),
                        pa.array([rows.feature[a:b].astype("<i4").tobytes() for a, b in spans], pa.binary()),
                        pa.array([rows.value[a:b].astype("<f8").tobytes() for a, b in spans], pa.binary()),
                        pa.array([x.astype("<f8").tobytes() for x in stats], pa.binary()),
                    ],
                    names=["key", "label", "features", "vals", "stats"],
                )

    named = docs.select(
        F.col(ident), F.xxhash64(ident, text).alias("key"), F.col(text), stated_length(length).alias(length)
    )
    sample = training_sample(named, labels, label, most, ident).select("key", "label", text, length)
    found = sample.mapInArrow(run, "key long, label int, features binary, vals binary, stats binary").collect()
    found.sort(key=lambda r: r["key"])
    words = [(np.frombuffer(r["features"], "<i4"), np.frombuffer(r["vals"], "<f8")) for r in found]
    stats = np.frombuffer(b"".join(r["stats"] for r in found), "<f8").reshape(len(found), KINDS + 8)
    return train(words, stats, np.array([r["label"] for r in found], dtype=float), label_share(labels, label, ident))


def stated_length(length: str):
    """The logarithm of the stated length; -1 where it is null."""
    return F.coalesce(F.log1p(F.greatest(F.col(length), F.lit(0)).cast("double")), F.lit(-1.0))


def score(docs: DataFrame, machine: Machine, *, keep: list[str], text: str = "text", length: str = "n_chars", name: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs`` and the probability of label 1."""
    return with_scores(docs, machine.scores, keep=keep, text=text, also=[stated_length(length)], name=name)


def kept(docs: DataFrame, machine: Machine, threshold: float, *, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more."""
    name = private(docs, "quality_score")
    scored = score(docs, machine, keep=docs.columns, text=text, length=length, name=name)
    return scored.filter(F.col(name) >= threshold).drop(name)
