"""Language model scores from a hierarchical Pitman-Yor model of words given the word before them.

Tokens are words and the end of a text. The context of a token is the word before it; every word is a context with a restaurant of
its own, and the first token of a text has one. All back off to the restaurant of words without context, and that to a uniform choice
among the known words and one unknown. A word is frequent if it makes up at least ``CONTEXT_SHARE`` of the training tokens; that bounds what
each task holds about words and contexts, at any input size, to 1 / ``CONTEXT_SHARE`` rows. No count is dropped.

In a context's restaurant the customers of a word sit at tables, each of which is a customer of the parent restaurant. A customer
sits at a table by its size less the discount, or at a new one by (strength + discount * tables) times the word's probability in
the parent. Probabilities need the number of tables only, so a sweep seats all customers of a word in a context again at once: it
draws their number of tables given where all others sit, from all numbers that there can be. The weight of t tables is the number of
ways to seat the customers at them, weighted by the discount (a generalised Stirling number), times the weights of t new tables. For up
to ``_LISTED`` customers all t are listed; beyond, numbers are proposed around the likeliest one and taken or not by their exact weights.
A sweep takes the cells in ``PARTS`` parts at random, and the parent's customers follow after each; tables are kept between sweeps and
turns; the first seating is drawn in order. The parent's own tables are drawn in order in each sweep, and the totals of restaurants,
to which all words contribute, are summed between turns. Probabilities of ``SAMPLES`` sweeps are averaged.

Layout: what belongs to a word after frequent words is in one bucket of words, what belongs to a rare context in one bucket of contexts, so a
sweep is local to buckets. Each holds of the other kind only what all tasks hold: totals of frequent contexts, and the root's customers of frequent
words. A pair of two rare words is in the bucket of its context; in each turn that tells the bucket of the word its tables, and is told the
root's customers of the word in return. Pairs of rare words in texts that are held out are there too, without customers, so that their
words' numbers are told as well. A bucket takes about ``BUCKET_TOKENS`` training tokens; words with more than that are counted and scored in as many copies of their rows, dealt by part of the corpus, and their counts meet once
merged. Rows of a part of the corpus carry all its words of a bucket. A task that scores sends, for each part, the sums of its texts in
one row.

Defined results: a null or empty text has the end token only; without training texts all words are
unknown and equally likely; null ids are training texts; rows with one id are scored apart; equal texts
get equal scores, up to rounding; scores do not depend on how the table is cut into files; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import new_path
from . import batches
from .text import fold

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(batches)

CONTEXT_SHARE = 1e-6  # of the training tokens; at least 2 ** -20, so that a context's number has 20 bits
BUCKET_TOKENS = 1 << 18
DISCOUNT, STRENGTH = 0.75, 3.0  # of the restaurants of contexts
ROOT_STRENGTH = 1.0  # the root's discount follows from how many words occur once and twice
TURNS, SWEEPS, PARTS, SAMPLES = 2, 4, 2, 3  # the last SAMPLES sweeps of the last turn are averaged
SEED = 3
FOLDS, HELD_OUT = 7, 2

END = 1  # the end of a text, among the hashes of words
_RARE = 0xFFFFF  # in place of the number of a word that is rare, whose hash stands beside
_COUNT_BUCKETS = 4096  # of the count without contexts
_HELD = 1 << 20  # words that a task counts before it sends them
_PART_BYTES = 3 << 19  # of texts whose words are numbered at once; a task needs about 60 times as much meanwhile
_ALONE = 64  # customers of a word that are seated one at a time at first
_LISTED = 512  # customers of a cell whose numbers of tables are listed
_LIST = 1 << 17  # numbers that are listed at once
_PROPOSED = 3  # numbers of tables proposed to a larger cell in a sweep
_NODES = 64  # of an integral
_MANY_BYTES = 1 << 24  # of the texts of a part that go to buckets in one row each; words take much less room once numbered
_PART_TEXTS = 1 << 12
_BLOCK = 1 << 10  # restaurants whose totals travel in one row
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SUM = (("doc", "<u2"), ("n", "<u4"), ("unknown", "<u4"), ("base", "<f8"), ("model", "<f8"))
_FLUSH = 1 << 18  # sums of texts that a task holds


def seat(customers: np.ndarray, base: np.ndarray, others: np.ndarray, discount: float, strength: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers sat down in order.

    ``base`` is the dish's probability in the parent restaurant, ``others`` the tables of other dishes.
    The first customer opens a table; the j-th opens one with the weight (strength + discount * all tables) *
    base against j - 1 - discount * own tables. Beyond ``_ALONE``, customers come in runs that double, and
    the number of tables that a run opens is drawn at once from its expectation.
    """
    tables = np.minimum(customers, 1).astype(np.float64)
    order = np.argsort(-customers, kind="stable")
    sizes = customers[order]
    for j in range(2, _ALONE + 1):
        n = int(np.searchsorted(-sizes, -j, side="right"))  # dishes with at least j customers
        if not n:
            return tables
        at = order[:n]
        t = tables[at]
        opens = (strength + discount * (others[at] + t)) * base[at]
        tables[at] = t + (rng.random(n) * (opens + j - 1 - discount * t) < opens)
    j = _ALONE
    while True:
        n = int(np.searchsorted(-sizes, -(j + 1), side="right"))
        if not n:
            return tables
        at = order[:n]
        t, stop = tables[at], np.minimum(sizes[:n], 2 * j)
        opens = (strength + discount * (others[at] + t)) * base[at]
        mean = opens * np.log((opens + stop - discount * t) / (opens + j - discount * t))
        tables[at] = t + np.minimum(rng.poisson(np.minimum(mean, stop - j)), stop - j)
        j *= 2


@dataclass
class Seating:
    """Who sits where in cells (a word in a context) of at least two customers: sizes of tables, in one array with
    room for those that may open. The rule for one customer at a time; :func:`seat_again` draws the tables of all from
    the distribution that its moves lead to, and tests hold the two against each other."""

    customers: np.ndarray
    begin: np.ndarray  # of each cell's room
    size: np.ndarray
    tables: np.ndarray

    @staticmethod
    def of(customers: np.ndarray, sizes: np.ndarray, tables: np.ndarray, more: int) -> "Seating":
        """From the sizes of each cell's tables, with room for ``more`` moves."""
        room = np.minimum(tables + more, customers)
        begin = np.cumsum(room) - room
        size = np.zeros(int(room.sum()), np.int64)
        nth = np.arange(len(sizes)) - np.repeat(np.cumsum(tables) - tables, tables)
        size[np.repeat(begin, tables) + nth] = sizes
        return Seating(customers, begin, size, tables.copy())

    @staticmethod
    def first(customers: np.ndarray, tables: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Sizes for given numbers of tables: one customer each, the others spread as unequally as the discount says."""
        cell = np.repeat(np.arange(len(customers)), tables)
        weight = rng.gamma(1 - DISCOUNT, 1.0, len(cell)) + 1e-9
        weight /= np.bincount(cell, weights=weight, minlength=len(customers))[cell]
        spare = (customers - tables)[cell] * weight
        sizes = 1 + np.floor(spare).astype(np.int64)
        rest = customers - np.bincount(cell, weights=sizes, minlength=len(customers)).astype(np.int64)
        first = np.cumsum(tables) - tables
        sizes[first] += rest  # what rounding left
        return sizes

    def packed(self) -> np.ndarray:
        """The sizes of the tables that are taken, cell by cell."""
        return self.size[self.size > 0]

    def move(self, new_table, rng: np.random.Generator) -> np.ndarray:
        """Seat one random customer of every cell again; ``new_table(tables, change)`` gives the weight of a new table once the
        customer has left, from the cells' tables and what the leaving has changed. Returns the change in each cell's tables."""
        n = len(self.customers)
        if not n:
            return np.zeros(0, np.int64)
        whole = np.cumsum(self.size)
        before = np.where(self.begin > 0, whole[self.begin - 1], 0)
        at = np.searchsorted(whole, before + rng.integers(0, self.customers) + 1)
        self.size[at] -= 1
        left = self.size[at] == 0
        self.tables -= left
        opens = new_table(self.tables, -left.astype(np.int64))
        weight = np.where(self.size > 0, self.size - DISCOUNT, 0.0)
        whole = np.concatenate(([0.0], np.cumsum(weight)))
        seated = self.customers - 1 - DISCOUNT * self.tables
        draw = rng.random(n) * (seated + opens)
        alone = draw >= seated
        to = np.searchsorted(whole, whole[self.begin] + draw, side="right") - 1
        last = np.append(self.begin[1:], len(self.size)) - 1
        to = np.clip(to, self.begin, last)
        free = np.minimum.reduceat(np.where(self.size == 0, np.arange(len(self.size)), len(self.size)), self.begin)
        to = np.where(alone, free, to)
        opened = self.size[to] == 0
        self.size[to] += 1
        self.tables += opened
        return opened.astype(np.int64) - left


def _ways(most: int) -> np.ndarray:
    """Logarithms of the weighted numbers of ways to seat n customers (rows) at t tables (columns), for n up to ``most``."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0.0
    with np.errstate(divide="ignore"):
        for n in range(most):
            join = np.log(np.maximum(n - DISCOUNT * np.arange(1, n + 2), 0))
            out[n + 1, 1 : n + 2] = np.logaddexp(out[n, : n + 1], join + out[n, 1 : n + 2])
    return out


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithms of the gamma function, for positive numbers."""
    x = np.asarray(x, float)
    shift = np.maximum(0, np.ceil(10 - x))
    product = np.ones_like(x)
    for i in range(int(shift.max(initial=0))):
        product *= np.where(i < shift, x + i, 1.0)
    y = x + shift
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * y * y)) / (y * y)) / (y * y)) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def _series(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """1 - (1 - z) ** DISCOUNT and z times its derivative, at z = exp(-p)."""
    rest = -np.expm1(-p)
    power = np.exp(DISCOUNT * np.log(rest))
    return -np.expm1(DISCOUNT * np.log(rest)), DISCOUNT * power / rest * np.exp(-p)


def _halved(above, n: int) -> np.ndarray:
    """Where ``above``, true at small p, becomes false, for each of ``n``."""
    low, high = np.full(n, -120.0), np.full(n, 3.3)
    for _ in range(40):
        middle = (low + high) / 2
        up = above(np.exp(middle))
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    return np.exp((low + high) / 2)


def _ways_of_many(n: np.ndarray, t: np.ndarray) -> np.ndarray:
    """As :func:`_ways`, for many customers: n! / (t! DISCOUNT ** t) times the coefficient of z ** n in (1 - (1 - z) ** DISCOUNT) ** t,
    an integral around 0 through the saddle point. Along a parabola where that is near the branch at z = 1, else along a circle."""

    def above(p):
        value, slope = _series(p)
        return t * slope > n * value

    p0 = _halved(above, len(n))
    near = p0 < 0.5
    mu = np.maximum(p0, 3 / n)[:, None]
    value, slope = _series(p0 * 1.0001)
    spread = np.maximum(n - t * slope / value, 1e-9) / (p0 * 0.0001)  # variance of the exponents of z there
    reach = np.where(near, np.sqrt(80 / (n * mu[:, 0])), np.minimum(np.pi, 9 / np.sqrt(spread)))[:, None]
    step = reach * (np.arange(_NODES) + 0.5) / _NODES
    p = np.where(near[:, None], mu * (1 + 1j * step) ** 2, p0[:, None] + 1j * step)
    weight = np.where(near[:, None], 2 * mu * (1 + 1j * step), 1.0)
    exponent = n[:, None] * p + t[:, None] * np.log(_series(p)[0])
    top = exponent.real.max(axis=1)
    sums = (np.exp(exponent - top[:, None]) * weight).real.sum(axis=1) * reach[:, 0] / _NODES / np.pi
    found = top + np.log(np.maximum(sums, 1e-300)) + _log_gamma(n + 1) - _log_gamma(t + 1) - t * np.log(DISCOUNT)
    return np.where(t < n, found, 0.0)


def seat_again(customers: np.ndarray, tables: np.ndarray, weight: tuple[np.ndarray, ...], ways: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The tables of cells once all their customers have been seated again. ``ways``: of :func:`_ways`; ``weight`` has five numbers of each cell, a to e: a new
    table beside k others has the weight (a + b * k) * (c + d * k) / (e + k)."""
    out = tables.copy()
    order = np.argsort(customers, kind="stable")
    sizes = customers[order]
    most = len(ways) - 1
    begin, listed = 0, int(np.searchsorted(sizes, most, side="right"))
    while begin < listed:
        n = int(sizes[begin])
        width = min(most, n if n < 5 else n + n // 3)
        end = min(int(np.searchsorted(sizes, width, side="right")), begin + max(1, _LIST // width))
        width = int(sizes[end - 1])
        at = order[begin:end]
        if n == width == 2:  # most cells: one table or two
            a, b, c, d, e = (x[at] for x in weight)
            one, two = np.exp(ways[2, 1]), np.exp(ways[2, 2]) * (a + b) * (c + d) / (e + 1)
            out[at] = 1 + (rng.random(len(at)) * (one + two) >= one)
            begin = end
            continue
        a, b, c, d, e = (x[at, None] for x in weight)
        k = np.arange(1, width)
        log = np.zeros((len(at), width))
        np.cumsum(np.log((a + b * k) * (c + d * k) / (e + k)), axis=1, out=log[:, 1:])
        log += ways[customers[at], 1 : width + 1]
        log -= log.max(axis=1, keepdims=True)
        whole = np.cumsum(np.exp(log, out=log), axis=1, out=log)
        draw = rng.random(len(at)) * whole[:, -1]
        out[at] = 1 + (whole <= draw[:, None]).sum(axis=1).clip(max=customers[at] - 1)
        begin = end
    if listed < len(order):
        at = order[listed:]
        out[at] = _seat_many(customers[at].astype(float), tables[at].astype(float), tuple(x[at] for x in weight), rng)
    return out


def _seat_many(n: np.ndarray, t: np.ndarray, weight: tuple[np.ndarray, ...], rng: np.random.Generator) -> np.ndarray:
    """As :func:`seat_again`, for cells of many customers: each proposed number is drawn around the likeliest one, whatever the
    present one, and replaces it by the ratio of their exact weights over how likely each is proposed."""
    a, b, c, d, e = weight

    def at_saddle(p):
        """About how many tables have their saddle point there, and the ratio of the weights of one more and of these."""
        value, slope = _series(p)
        k = n * value / slope
        return k, np.log((a + b * k) * (c + d * k) / (e + k)) + np.log(value) - np.log(DISCOUNT * k)

    def weighed(k):
        rises = [(k - 1) * np.log(y) + _log_gamma(x / y + k) - _log_gamma(x / y + 1) for x, y in ((a, b), (c, d), (e, 1.0))]
        return _ways_of_many(n, k) + rises[0] + rises[1] - rises[2]

    def below(k):  # Student's distribution with two degrees of freedom
        z = (k - likely) / scale
        return 0.5 + z / (2 * np.sqrt(2 + z * z))

    p = _halved(lambda p: at_saddle(p)[1] > 0, len(n))
    likely, _ = at_saddle(p)
    (less, high), (more, low) = at_saddle(p * 0.999), at_saddle(p * 1.001)
    scale = np.clip(np.sqrt((more - less) / np.maximum(high - low, 1e-9)), 1, n)
    drawn = np.rint(likely + scale * rng.standard_t(2, (_PROPOSED, len(n))))
    inside = (drawn >= 1) & (drawn <= n)
    tried = [t, *np.where(inside, drawn, t)]
    n, a, b, c, d, e, likely, scale = (np.tile(x, len(tried)) for x in (n, a, b, c, d, e, likely, scale))
    k = np.concatenate(tried)
    gain = (weighed(k) - np.log(below(k + 0.5) - below(k - 0.5))).reshape(len(tried), -1)
    now, best = t, gain[0]
    for number in range(_PROPOSED):
        taken = inside[number] & (np.log(rng.random(len(t))) < gain[number + 1] - best)
        now, best = np.where(taken, tried[number + 1], now), np.where(taken, gain[number + 1], best)
    return now


@dataclass
class Tokens:
    """The tokens of some texts, the end of each text included: hash and text of each, and which token is before it in its text, or -1."""

    hash: np.ndarray
    doc: np.ndarray
    before: np.ndarray
    contexts: np.ndarray

    @staticmethod
    def of(texts: list[bytes], contexts: np.ndarray) -> "Tokens":
        """``contexts``: the hashes of the frequent words, in order."""
        words = batches.Words(texts, by_space=True)
        hashes = words.hash.view(np.int64)
        begin, stop = words.first[:-1], words.first[1:]
        inner = np.arange(len(hashes)) - 1
        inner[begin[begin < stop]] = -1
        return Tokens(
            np.concatenate([hashes, np.full(len(texts), END)]),
            np.concatenate([words.doc, np.arange(len(texts))]),
            np.concatenate([inner, np.where(begin < stop, stop - 1, -1)]),
            contexts,
        )

    @staticmethod
    def together(texts: list[bytes], contexts: np.ndarray) -> "Tokens":
        """As :meth:`of`, a run of texts at a time."""
        found, size = [], 0
        for begin, end in _cut(texts, _PART_BYTES):
            t = Tokens.of(texts[begin:end], contexts)
            found.append((t.hash, (t.doc + begin).astype(np.int32), np.where(t.before >= 0, t.before + size, -1).astype(np.int32)))
            size += len(t.hash)
        return Tokens(*(np.concatenate(x) for x in zip(*found)), contexts)

    def numbered(self, hashes: np.ndarray, each: np.ndarray) -> np.ndarray:
        """The context of each token, given the distinct hashes and which of them each token has. The number after those of the frequent words is
        that of rare words, the next one that of a text's beginning."""
        number = _place(self.contexts, hashes, len(self.contexts)).astype(np.int32)
        return np.where(self.before >= 0, number[each[self.before]], np.int32(len(self.contexts) + 1))

    @property
    def context(self) -> np.ndarray:
        return self.numbered(self.hash, np.arange(len(self.hash)))


def _place(known: np.ndarray, hashes: np.ndarray, missing: int) -> np.ndarray:
    """Where each hash is among those known, in order, or ``missing``."""
    if not len(known):
        return np.full(len(hashes), missing)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, missing)


def _firsts(sorted_: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(sorted_) else np.zeros(0, np.int64)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its numbers."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = _firsts(keys)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _spread(hashes: np.ndarray) -> np.ndarray:
    return batches.mix64(hashes.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))


def _pieces(bucket: np.ndarray, columns: dict[str, tuple[np.ndarray, np.ndarray | None]]):
    """(bucket, {name: bytes}) for each bucket, from arrays sorted by it. A column has its values and, if it has several for a
    word, where those of each word begin (with the end)."""
    first = _firsts(bucket)
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(bucket)]):
        yield int(bucket[a]), {n: (v[a:b] if at is None else v[at[a] : at[b]]).tobytes() for n, (v, at) in columns.items()}


def _batches(rows, schema: str, most: int = 1 << 22):
    """Record batches of bounded size from rows as tuples."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names = [c.split() for c in schema.split(", ")]

    def made(held):
        return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[k]) for c, (_, k) in zip(zip(*held), names)], names=[n for n, _ in names])

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size > most or len(held) >= 1 << 12:
            yield made(held)
            held, size = [], 0
    if held:
        yield made(held)


def _rows_of(parts):
    """The rows of a task's batches as dictionaries, one at a time."""
    for batch in parts:
        for i in range(batch.num_rows):
            yield {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns)}


_COUNTS = "bucket int, words binary, n binary"


def word_counts(texts: DataFrame) -> DataFrame:
    """Rows (bucket, words, n): every training token and how often it occurs, each in one bucket."""

    def rows(keys, n):
        bucket = (_spread(keys) % np.uint64(_COUNT_BUCKETS)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for b, c in _pieces(bucket[order], {"words": (keys[order].astype("<i8"), None), "n": (n[order].astype("<i8"), None)}):
            yield b, c["words"], c["n"]

    def count(parts):
        held, new = (np.zeros(0, np.int64), np.zeros(0, np.int64)), []
        for batch in parts:
            for part in batches.slices(batch, "text", _PART_BYTES):
                words = batches.Words(batches.column_bytes(part.column("text")), by_space=True).hash.view(np.int64)
                new.append(np.unique(np.concatenate([words, np.full(part.num_rows, END)]), return_counts=True))
                if sum(len(k) for k, _ in new) > len(held[0]):
                    held, new = _summed(*(np.concatenate(x) for x in zip(held, *new))), []
                if len(held[0]) > _HELD:
                    yield from _batches(rows(*held), _COUNTS)
                    held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        held = _summed(*(np.concatenate(x) for x in zip(held, *new)))
        yield from _batches(rows(*held), _COUNTS)

    def merge(parts):
        def merged():
            bucket, held = None, []
            for row in _rows_of(parts):
                if row["bucket"] != bucket:
                    if held:
                        yield total(bucket, held)
                    bucket, held = row["bucket"], []
                held.append((np.frombuffer(row["words"], "<i8"), np.frombuffer(row["n"], "<i8")))
            if held:
                yield total(bucket, held)

        def total(bucket, held):
            keys, n = _summed(*(np.concatenate(x) for x in zip(*held)))
            return bucket, keys.tobytes(), n.tobytes()

        yield from _batches(merged(), _COUNTS)

    return texts.select("text").mapInArrow(count, _COUNTS).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, _COUNTS)


@dataclass
class Model:
    """What is known beside the rows of the buckets. ``customers`` and ``tables`` are by restaurant: frequent contexts, none, beginnings,
    and last the root; ``tables`` and the root's customers have a row for each sample."""

    known: int = 0  # distinct training tokens
    trained: int = 0  # training tokens
    discount: float = 0.5  # of the root
    contexts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    common: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # words that are dealt in copies, in order
    copies: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    buckets: int = 1
    customers: np.ndarray | None = None
    tables: np.ndarray | None = None
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # the frequent ones and the end, in order
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # how often each occurs in training
    extra: np.ndarray | None = None  # the root's customers of each that come from rare contexts, and last of all words
    roots: np.ndarray | None = None  # the root's customers and tables of each, for each sample

    @staticmethod
    def of(counts: DataFrame) -> "Model":
        def tally(parts):
            out = np.zeros(4, np.int64)
            for row in _rows_of(parts):
                n = np.frombuffer(row["n"], "<i8")
                out += [n.sum(), len(n), (n == 1).sum(), (n == 2).sum()]
            yield pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in out], names=list("abcd"))

        sums = counts.mapInArrow(tally, "a long, b long, c long, d long").agg(*(F.sum(c) for c in "abcd")).first()
        trained, known, once, twice = (int(x or 0) for x in sums)
        buckets = 1 << max(4, (max(trained, 1) // BUCKET_TOKENS).bit_length())
        least = max(1.0, trained * CONTEXT_SHARE)

        def frequent(parts):
            for row in _rows_of(parts):
                n, words = np.frombuffer(row["n"], "<i8"), np.frombuffer(row["words"], "<i8")
                chosen = (n >= least) | (words == END)  # the end has a number in any case
                yield pa.RecordBatch.from_arrays([pa.array(words[chosen]), pa.array(n[chosen])], names=["word", "n"])

        found = counts.mapInArrow(frequent, "word long, n long").collect()  # at most 1 / CONTEXT_SHARE rows
        words, n = (np.array([r[i] for r in found], dtype=np.int64) for i in (0, 1))
        if not len(words):
            words, n = np.array([END]), np.zeros(1, np.int64)
        order = np.argsort(words)
        words, n = words[order], n[order]
        copies = -(-n * buckets // max(trained, 1))
        many = copies > 1
        discount = min(max(once / max(1.0, once + 2 * twice), 0.1), 0.9)
        return Model(known, trained, discount, words[words != END], words[many], copies[many], buckets, words=words, counts=n)

    @property
    def restaurants(self) -> int:
        return len(self.contexts) + 2

    def copies_of(self, words: np.ndarray) -> np.ndarray:
        if not len(self.common):
            return np.ones(len(words), np.int64)
        at = _place(self.common, words, -1)
        return np.where(at >= 0, self.copies[at], 1)

    @property
    def context_buckets(self) -> int:
        rare = max(0, self.trained - int(self.counts.sum()))
        return 1 << max(4, (rare // BUCKET_TOKENS).bit_length())

    def context_bucket(self, words: np.ndarray) -> np.ndarray:
        """Numbers after those of words and those of rare words."""
        return 2 * self.buckets + (_spread(words) % np.uint64(self.context_buckets)).astype(np.int64)

    def extra_of(self, words: np.ndarray) -> np.ndarray:
        if self.extra is None:
            return np.zeros(len(words))
        at = _place(self.words, words, -1)
        return np.where(at >= 0, self.extra[at], 0.0)

    def bucket(self, words: np.ndarray, copy: np.ndarray) -> np.ndarray:
        spread = batches.mix64(_spread(words) + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return (spread % np.uint64(self.buckets)).astype(np.int64)

    @cached_property
    def shares(self) -> np.ndarray:
        """Of the restaurants' probabilities: what a customer of a word gives, and for each sample what its probability in the root gives."""
        each = 1 / (STRENGTH + self.customers[0])
        return np.stack([each, *((STRENGTH + DISCOUNT * self.tables) * each)])

    @cached_property
    def known_roots(self) -> np.ndarray:
        """The probabilities in the root of frequent words and, last, of a word without customers, for each sample."""
        pad = np.zeros((2, self.roots.shape[1], 1))
        return np.stack([self.root(*x, s) for s, x in enumerate(np.concatenate([self.roots, pad], axis=2).swapaxes(0, 1))])

    def root(self, customers: np.ndarray, tables: np.ndarray, sample: int = 0) -> np.ndarray:
        """Predictive probabilities of words in the root, from their customers and tables there."""
        rest = (ROOT_STRENGTH + self.discount * self.tables[sample, -1]) / (self.known + 1)
        own = np.maximum(customers - self.discount * tables, 0)
        return (own + rest) / (ROOT_STRENGTH + self.customers[sample, -1])

    def context(self, customers: np.ndarray, tables: np.ndarray, context: np.ndarray, root: np.ndarray, sample: int = 0) -> np.ndarray:
        """Predictive probabilities in the contexts' restaurants."""
        rest = STRENGTH + DISCOUNT * self.tables[sample, context]
        own = np.maximum(customers - DISCOUNT * tables, 0)
        return (own + rest * root) / (STRENGTH + self.customers[sample, context])


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes in order, and which of them each is (as :func:`numpy.unique`, by hashing)."""
    found = pa.array(hashes).dictionary_encode()
    distinct = found.dictionary.to_numpy()
    order = np.argsort(distinct)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    distinct, each = distinct[order], rank[found.indices.to_numpy()]
    del found
    pa.default_memory_pool().release_unused()
    return distinct, each


def _counted(pair: np.ndarray, seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each pair as often as its number needs entries of at most 4095, one at least, and what they hold."""
    if seen is None:
        pair = np.sort(pair)
        first = _firsts(pair)
        pair, n = pair[first], np.diff(np.append(first, len(pair)))
    else:
        pair, back = np.unique(pair, return_inverse=True)
        n = np.bincount(back, weights=seen, minlength=len(pair)).astype(np.int64)
    more = np.maximum((n + 4094) // 4095, 1)
    if len(more) and more.max() == 1:
        return pair, n
    nth = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
    return np.repeat(pair, more), np.minimum(np.repeat(n, more) - 4095 * nth, 4095)


def _cut(texts: list[bytes], most: int):
    """Where each run of texts begins and ends that take about ``most`` bytes."""
    part = np.cumsum([len(x) + 64 for x in texts]) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    return zip(edges[:-1], edges[1:])


def _places(texts: list[bytes], model: Model, number: int, held: np.ndarray | None = None):
    """Rows (bucket, words, lengths, entries, rare) of a part. An entry has 20 bits for the context and 12 for the text (below), or, if it is told
    which texts are held out, for how often the pair occurs in the others (above); what occurs more often has several.

    After a frequent word a token goes to its own bucket, with the number of the context. After a rare word it goes to the bucket of that
    context, with the number of its word, or with the hash if that is rare too. The buckets of words hear of all training words, and those of
    contexts of all pairs of rare words, if only with an entry of 0."""
    tokens = Tokens.together(texts, model.contexts)
    hashes, each = _distinct(tokens.hash)
    tokens.hash = hashes[:0]  # not needed again, and large
    context = tokens.numbered(hashes, each)
    rare = context == len(model.contexts)
    own = ~rare
    if held is not None:
        own &= ~held[tokens.doc]

    def entries(key, low, doc):
        """How many entries each word has, and the entries in order."""
        pair = key.astype(np.int64)
        pair <<= 32 if held is None else 20
        low = low.astype(np.int64)
        if held is None:
            low <<= 12
            low |= doc
            pair |= low
            del low
            pair.sort()
            return np.bincount(pair >> 32, minlength=len(hashes)), pair.astype(np.uint32)
        pair |= low
        del low
        pair, n = _counted(pair)
        return np.bincount(pair >> 20, minlength=len(hashes)), (n << 20 | pair & 0xFFFFF).astype(np.uint32)

    lengths, entry = entries(each[own], context[own], tokens.doc[own])
    del own, context
    at = np.flatnonzero(rare).astype(np.int32)
    seen = np.ones(len(at), bool) if held is None else ~held[tokens.doc[at]]
    if held is not None:
        absent = np.zeros(len(hashes), bool)
        absent[each[at[seen]]] = True
        absent &= lengths == 0
        entry = np.insert(entry, (np.cumsum(lengths) - lengths)[absent], len(model.contexts))
        lengths[absent] = 1
    salt = int(batches.mix64(np.array([number & 0xFFFFFFFFFFFFFFFF], np.uint64))[0] >> np.uint64(33))
    yield from _packed(hashes, lengths, entry, lambda words: model.bucket(words, salt % model.copies_of(words)))

    place = _place(model.words, hashes, _RARE)[each[at]]
    mine = (place != _RARE) & seen
    yield from _packed(hashes, *entries(each[tokens.before[at[mine]]], place[mine], tokens.doc[at[mine]]), model.context_bucket)

    at, seen = at[place == _RARE], seen[place == _RARE]
    key, other = each[tokens.before[at]].astype(np.int64), each[at]
    if held is None:
        order = np.lexsort((other, key))
        key, other, entry = key[order], other[order], _RARE << 12 | tokens.doc[at][order].astype(np.int64)
    else:
        pair, n = _counted(key * len(hashes) + other, seen)
        key, other, entry = pair // len(hashes), pair % len(hashes), n << 20 | _RARE
    yield from _packed(hashes, np.bincount(key, minlength=len(hashes)), entry.astype(np.uint32), model.context_bucket, hashes[other])


def _packed(hashes: np.ndarray, lengths: np.ndarray, entry: np.ndarray, bucket_of, other: np.ndarray | None = None):
    """A row for each bucket, from how many entries each of the hashes has, and the entries in their order."""
    mine = np.flatnonzero(lengths)
    words, lengths = hashes[mine], lengths[mine]
    bucket = bucket_of(words)
    order = np.argsort(bucket.astype(np.int32), kind="stable")
    begin = np.cumsum(lengths) - lengths
    words, lengths, bucket = words[order], lengths[order], bucket[order]
    at = np.append(0, np.cumsum(lengths))
    taken = np.repeat((begin[order] - at[:-1]).astype(np.int32), lengths)
    taken += np.arange(len(entry), dtype=np.int32)
    columns = {"words": (words.astype("<i8"), None), "lengths": (lengths.astype("<u4"), None), "entries": (entry[taken], at)}
    columns["rare"] = (other[taken].astype("<i8") if other is not None else np.zeros(0, "<i8"), at if other is not None else np.zeros_like(at))
    for number, c in _pieces(bucket, columns):
        yield number, {n: _shut(x, 4 if n in ("lengths", "entries") else 8) for n, x in c.items()}


def _shut(given: bytes, width: int = 8) -> bytes:
    """Numbers of that many bytes, compressed: all first bytes, then all second ones and so on. Begins with their size."""
    if not given:
        return b""
    width = width if len(given) % width == 0 else 4
    planes = np.frombuffer(given, np.uint8).reshape(-1, width).T.tobytes()
    return (len(given) << 8 | width).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True)


def _opened(shut: bytes) -> bytes:
    if not shut:
        return b""
    head = int.from_bytes(shut[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(shut[8:], head >> 8), np.uint8)
    return planes.reshape(head & 0xFF, -1).T.tobytes()


def _sent(rows: DataFrame) -> DataFrame:
    """Rows on their way to other tasks: their arrays compressed, until :func:`_rows_sent` reads them."""
    schema = ", ".join(f"{c} {'long' if kind == 'bigint' else kind}" for c, kind in rows.dtypes)

    def run(parts):
        yield from _batches((tuple(_shut(x) if isinstance(x, bytes) else x for x in row.values()) for row in _rows_of(parts)), schema)

    return rows.mapInArrow(run, schema)


def _rows_sent(parts):
    """The rows of a task's batches that :func:`_sent` or :func:`_packed` compressed."""
    for row in _rows_of(parts):
        yield {n: _opened(x) if isinstance(x, bytes) else x for n, x in row.items()}


def _steps(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits as the steps between them, which compress well where they rise."""
    return np.diff(numbers.astype("<u4"), prepend=np.uint32(0)).astype("<u4").tobytes()


def _stepped(steps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, "<u4"), dtype=np.uint32).astype(np.int64)


def _stored(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written once, well compressed, and read back. What they were shuffled through goes once they are written."""
    spark, path = rows.sparkSession, new_path(rows.sparkSession, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        rows.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(rows.schema).parquet(path)


_CELLS = "bucket long, words binary, lengths binary, contexts binary, customers binary"
_KEPT = _CELLS + ", rare binary"


def vocabulary(texts: DataFrame, model: Model) -> DataFrame:
    """Rows (bucket, words, lengths, contexts, customers): the frequent words of a bucket, in how many frequent contexts each occurs, which (as
    steps), and how often."""
    return frequent(cells(texts, model), model)


def cells(texts: DataFrame, model: Model) -> DataFrame:
    """The cells of all buckets, stored: words in frequent contexts by word, and words in rare contexts by context. Of texts that are held out
    (column ``held``, if there is one) only pairs of rare words are there, with no customer."""

    def count(parts):
        def rows():
            for number, part in _numbered(parts):
                held = part.column("held").to_numpy(zero_copy_only=False)
                for bucket, c in _places(batches.column_bytes(part.column("text")), model, number, held):
                    yield bucket, c["words"], c["lengths"], c["entries"], c["rare"]

        yield from _batches(rows(), schema)

    def opened(row):
        entries, lengths = np.frombuffer(row["entries"], "<u4").astype(np.int64), np.frombuffer(row["lengths"], "<u4")
        other = np.frombuffer(row["rare"], "<i8") if row["rare"] else entries & 0xFFFFF
        return np.repeat(np.frombuffer(row["words"], "<i8"), lengths), other, entries >> 20

    schema = "bucket long, words binary, lengths binary, entries binary, rare binary"
    held = F.col("held") if "held" in texts.columns else F.lit(False)
    entries = texts.select("text", held.alias("held")).mapInArrow(count, schema)
    return _stored(entries.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merged(model, opened, True), _KEPT), "lm-cells")


def frequent(stored: DataFrame, model: Model) -> DataFrame:
    """The rows of frequent words, of those that are dealt in copies too."""

    def opened(row):
        words = np.repeat(np.frombuffer(row["words"], "<i8"), np.frombuffer(row["lengths"], "<u4"))
        return words, _stepped(row["contexts"]), np.frombuffer(row["customers"], "<i8")

    mine = stored.drop("rare")
    copied = _sent(mine.filter("bucket < 0")).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merged(model, opened, False), _KEPT)
    return mine.filter(f"bucket >= 0 AND bucket < {model.buckets}").unionByName(copied.drop("rare"))


def _merged(model: Model, opened, split: bool):
    """What merges the rows of each bucket, in their order."""

    def rows_of(bucket, held):
        words, others, n = _cells(held)
        if bucket >= 2 * model.buckets:
            rare = (others < 0) | (others > _RARE)
            lengths = np.diff(np.append(_firsts(words), len(words)))
            numbers = _steps(np.where(rare, _RARE, others))
            yield bucket, words[_firsts(words)].tobytes(), lengths.astype("<u4").tobytes(), numbers, n.astype("<i8").tobytes(), others[rare].tobytes()
            return
        home = np.full(len(words), bucket)
        if split:  # common words go on to the bucket that all their copies share, and rare words go apart
            copied = model.copies_of(words) > 1
            home[copied] = -1 - model.bucket(words[copied], np.zeros(copied.sum(), np.int64))
            home[_place(model.words, words, -1) < 0] = model.buckets + bucket
        for b in np.unique(home).tolist():
            w, first = words[home == b], _firsts(words[home == b])
            here, others_, n_ = np.append(first, len(w)), others[home == b], n[home == b]
            there = n_ > 0 if b >= 0 or not split else np.ones(len(w), bool)
            lengths = np.diff(np.append(0, np.cumsum(there))[here])
            yield b, w[first].tobytes(), lengths.astype("<u4").tobytes(), _steps(others_[there]), n_[there].astype("<i8").tobytes(), b""

    def run(parts):
        def rows():
            bucket, held, size = None, [], 0
            for row in _rows_sent(parts):
                if row["bucket"] != bucket:
                    if held:
                        yield from rows_of(bucket, held)
                    bucket, held, size = row["bucket"], [], 0
                held.append(opened(row))
                size += len(held[-1][0])
                if size > 4 * BUCKET_TOKENS:  # cells are fewer than entries
                    held = [_cells(held)]
                    size = len(held[0][0]) // 2
            if held:
                yield from rows_of(bucket, held)

        yield from _batches(rows(), _KEPT)

    return run


def _cells(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, contexts and counts, by word and context, each pair once."""
    words, contexts, n = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((contexts, words))
    words, contexts, n = words[order], contexts[order], n[order]
    first = np.flatnonzero(np.append(True, (words[1:] != words[:-1]) | (contexts[1:] != contexts[:-1])))
    return words[first], contexts[first], np.add.reduceat(n, first)


@dataclass
class Row:
    """A row of a bucket as arrays: words, the word of each cell, its context and customers."""

    words: np.ndarray
    word: np.ndarray
    context: np.ndarray
    customers: np.ndarray

    @staticmethod
    def of(row: dict) -> "Row":
        lengths = np.frombuffer(row["lengths"], "<u4")
        words = np.frombuffer(row["words"], "<i8")
        return Row(words, np.repeat(np.arange(len(words)), lengths), _stepped(row["contexts"]), np.frombuffer(row["customers"], "<i8"))


#: What sweeps add: tables of cells of several customers, and for each sample the tables of those cells and the root's customers
#: and tables of each word (in rows of contexts, of the rare word of each cell that has one). ``more``: how often each word occurs after rare words
#: (there, how often the rare word occurs).
_SWEPT = _CELLS + ", tables binary, samples binary, root_customers binary, root_tables binary"
_EXCHANGED = _SWEPT + ", rare binary, more binary, extra binary, source binary, kind int"
_MESSAGE, _STATE = 0, 1


def _drawn_again(rows: "Row", many: np.ndarray, tables: np.ndarray, others, root, model: Model, sample: int, ways: np.ndarray, rng: np.random.Generator):
    """A sweep: all cells of several customers, in parts. ``others``: of some cells, the tables of other words in their contexts; ``root``: the
    root's customers of their words that come from elsewhere, all of them as its total has them, and their tables there. Yields the
    cells of a part and their new tables, which the caller puts into ``tables``."""
    rest = (ROOT_STRENGTH + model.discount * model.tables[sample, -1]) / (model.known + 1)
    part = rng.integers(0, PARTS, len(many))
    for at in (np.flatnonzero(part == one) for one in range(PARTS)):
        away, counted, root_tables = root(at)
        # a word's customers in the root keep their share of tables there, whatever their number
        each = 1 - model.discount * np.minimum((root_tables - 1) / np.maximum(away + tables[at] - 1, 1), 1)
        elsewhere = ROOT_STRENGTH + np.maximum(model.customers[sample, -1] - counted, 0)  # the root's customers of other words
        weight = (STRENGTH + DISCOUNT * others(at), np.full(len(at), DISCOUNT), 1 - model.discount + rest + each * (away - 1), each, elsewhere + away)
        yield at, seat_again(rows.customers[many[at]], tables[at], weight, ways, rng)


def _swept(row: dict, model: Model, turn: int, ways: np.ndarray, extra: np.ndarray) -> dict:
    """A row of words after the sweeps of a turn. ``extra``: customers that come to the root from rare contexts."""
    samples = SAMPLES if turn == TURNS - 1 else 1
    r = Row.of(row)
    many = np.flatnonzero(r.customers > 1)
    rng = np.random.default_rng([SEED, turn, row["bucket"] % (1 << 63), int(r.words[0]) % (1 << 63)])
    context, customers, word = r.context[many], r.customers[many], r.word[many]
    singles = np.bincount(r.word[r.customers == 1], minlength=len(r.words)) + extra
    uniform = np.full(len(r.words), 1 / (model.known + 1))
    if row.get("tables") is None:
        arrived = np.bincount(r.word, minlength=len(r.words)) + extra
        root_tables = np.minimum(arrived, 1).astype(float)
        others = np.maximum(model.tables[0, context] - 1, 0)
        tables = seat(customers, model.root(arrived, root_tables)[word], others, DISCOUNT, STRENGTH, rng).astype(np.int64)
        tables = np.minimum(tables, customers)
        counted = np.ones(len(many), np.int64)  # what the totals have
    else:
        tables = np.frombuffer(row["tables"], "<u4").astype(np.int64)
        root_tables = np.frombuffer(row["root_tables"], "<f8")
        counted = tables.copy()
    arrived = singles + np.bincount(word, weights=tables, minlength=len(r.words))
    others = np.maximum(model.tables[0, context] - counted, 0)
    whole = singles + np.bincount(word, weights=counted, minlength=len(r.words))
    kept: list[list[np.ndarray]] = [[], [], []]
    for number in range(SWEEPS):

        def root(at):
            w = word[at]
            return arrived[w] - tables[at], whole[w], root_tables[w]

        for at, now in _drawn_again(r, many, tables, lambda at: others[at], root, model, 0, ways, rng):
            arrived = arrived + np.bincount(word[at], weights=now - tables[at], minlength=len(r.words))
            tables[at] = now
        root_tables = seat(arrived.astype(np.int64), uniform, np.maximum(model.tables[0, -1] - root_tables, 0), model.discount, ROOT_STRENGTH, rng)
        if number >= SWEEPS - samples:
            for out, now in zip(kept, (tables.astype("<u4"), arrived.astype("<f8"), root_tables.astype("<f8"))):
                out.append(now)
    out = {c: row[c] for c in ("bucket", "words", "lengths", "contexts", "customers")}
    out["tables"] = None if turn == TURNS - 1 else tables.astype("<u4").tobytes()
    return out | {c: np.concatenate(x).tobytes() for c, x in zip(("samples", "root_customers", "root_tables"), kept)}


def _contexts_swept(row: dict, model: Model, turn: int, ways: np.ndarray, root_customers: np.ndarray, root_tables: np.ndarray) -> dict:
    """A row of rare contexts after the sweeps of a turn. ``root_customers`` and ``root_tables`` have the root's of rare words, by sample and cell
    that has one; they and those of frequent words are those of the turn's sweeps of words."""
    samples = SAMPLES if turn == TURNS - 1 else 1
    r = Row.of(row)
    many = np.flatnonzero(r.customers > 1)
    rng = np.random.default_rng([SEED, turn, row["bucket"] % (1 << 63), int(r.words[0]) % (1 << 63)])
    rare = r.context == _RARE
    now = len(model.roots[0]) - 1
    root = np.zeros((2, len(r.context)))
    for i, own in enumerate((root_customers, root_tables)):
        root[i, ~rare], root[i, rare] = model.roots[i][now][r.context[~rare]], own[now]
    customers, word, root = r.customers[many], r.word[many], root[:, many]
    singles = np.bincount(r.word[r.customers == 1], minlength=len(r.words))
    if row.get("tables") is None:
        others = np.bincount(r.word[r.customers > 0], minlength=len(r.words))[word] - 1
        tables = seat(customers, model.root(root[0], root[1], now), others, DISCOUNT, STRENGTH, rng).astype(np.int64)
        tables = np.minimum(tables, customers)
        counted = np.ones(len(many), np.int64)
    else:
        tables = np.frombuffer(row["tables"], "<u4").astype(np.int64)
        counted = tables.copy()
    whole = singles + np.bincount(word, weights=tables, minlength=len(r.words))  # tables in each restaurant
    kept = []
    for number in range(SWEEPS):

        def others(at):
            return whole[word[at]] - tables[at]

        for at, drawn in _drawn_again(
            r, many, tables, others, lambda at: (np.maximum(root[0, at] - counted[at], 0), root[0, at], root[1, at]), model, now, ways, rng
        ):
            whole = whole + np.bincount(word[at], weights=drawn - tables[at], minlength=len(r.words))
            tables[at] = drawn
        if number >= SWEEPS - samples:
            kept.append(tables.astype("<u4"))
    out = {c: row[c] for c in ("bucket", "words", "lengths", "contexts", "customers", "rare")}
    out |= {"tables": tables.astype("<u4").tobytes(), "samples": np.concatenate(kept).tobytes()}
    return out | {"root_customers": root_customers.astype("<f8").tobytes(), "root_tables": root_tables.astype("<f8").tobytes()}


def swept(rows: DataFrame, model: Model, turn: int) -> DataFrame:
    """The rows of frequent words after the sweeps of a turn."""
    names = [c.split()[0] for c in _SWEPT.split(", ")]

    def run(parts):
        ways = _ways(_LISTED)

        def rows():
            for row in _rows_of(parts):
                out = _swept(row, model, turn, ways, model.extra_of(np.frombuffer(row["words"], "<i8")))
                yield tuple(out[c] for c in names)

        yield from _batches(rows(), _SWEPT)

    return rows.mapInArrow(run, _SWEPT)


def _exchanged(out: dict) -> tuple:
    return tuple(out.get(c.split()[0]) for c in _EXCHANGED.split(", "))


class _Post:
    """Messages of a task to buckets, until they are sent: a row for each bucket."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, dict[str, np.ndarray]]] = []
        self.size = 0

    def add(self, to: np.ndarray, **columns: np.ndarray) -> None:
        if len(to):
            self.held.append((to, columns))
            self.size += len(to)

    def rows(self):
        if self.held:
            to = np.concatenate([x for x, _ in self.held])
            columns = {c: np.concatenate([x[c] for _, x in self.held]) for c in self.held[0][1]}
            order = np.argsort(to, kind="stable")
            self.held, self.size = [], 0
            for bucket, c in _pieces(to[order], {n: (v[order], None) for n, v in columns.items()}):
                yield _exchanged(c | {"bucket": bucket, "kind": _MESSAGE})


def _met(rows: DataFrame, messages: DataFrame, seated) -> DataFrame:
    """Messages and the rows that they are for, bucket by bucket, through ``seated(bucket, messages, row or None, post)``, which yields rows."""

    def run(parts):
        post = _Post()

        def rows_():
            bucket, held, state = None, [], None
            for row in _rows_sent(parts):
                if row["bucket"] != bucket:
                    if bucket is not None:
                        yield from seated(bucket, held, state, post)
                    bucket, held, state = row["bucket"], [], None
                if row["kind"] == _MESSAGE:
                    held.append(row)
                else:
                    state = row
                if post.size > _HELD:
                    yield from post.rows()
            if bucket is not None:
                yield from seated(bucket, held, state, post)
            yield from post.rows()

        yield from _batches(rows_(), _EXCHANGED)

    both = rows.withColumn("kind", F.lit(_STATE)).unionByName(messages, allowMissingColumns=True)
    names = [c.split()[0] for c in _EXCHANGED.split(", ")]
    both = both.select("bucket", *[c for c in names if c in both.columns and c != "bucket"])
    return _sent(both).repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(run, _EXCHANGED)


def _told(held: list[dict], **kinds: str) -> list[np.ndarray]:
    """Columns of messages, together."""
    return [np.concatenate([np.frombuffer(row[c], kind) for row in held] or [np.zeros(0, kind)]) for c, kind in kinds.items()]


def rare_words_swept(rows: DataFrame, asked: DataFrame, model: Model, turn: int) -> DataFrame:
    """Rows of rare words after the sweeps of a turn, and messages to rare contexts: what the root has of the words that they asked for."""
    samples = SAMPLES if turn == TURNS - 1 else 1
    ways: list[np.ndarray] = []

    def seated(bucket, held, state, post):
        if not ways:
            ways.append(_ways(_LISTED))
        words, source, tables, n = _told(held, words="<i8", source="<i8", extra="<u4", customers="<i8")
        # each word once for each bucket that asks
        order = np.lexsort((words, source))
        words, source, tables, n = words[order], source[order], tables[order], n[order]
        first = np.flatnonzero(np.append(True, (words[1:] != words[:-1]) | (source[1:] != source[:-1]))) if len(words) else np.zeros(0, np.int64)
        root, count = np.zeros((2, samples, len(first))), np.zeros(len(first), np.int64)
        if state is not None:
            known = np.frombuffer(state["words"], "<i8")
            at = _place(known, words, len(known))
            extra = np.bincount(at, weights=tables, minlength=len(known) + 1)[:-1]
            more = np.bincount(at, weights=n, minlength=len(known) + 1)[:-1].astype(np.int64)
            out = _swept(state, model, turn, ways[0], extra)
            yield _exchanged(out | {"more": more.astype("<i8").tobytes(), "kind": _STATE})
            r = Row.of(state)
            whole = more + np.bincount(r.word, weights=r.customers, minlength=len(known)).astype(np.int64)
            there, place = at[first] < len(known), np.minimum(at[first], len(known) - 1)
            for i, c in enumerate(("root_customers", "root_tables")):
                root[i] = np.where(there, np.frombuffer(out[c], "<f8").reshape(samples, -1)[:, place], 0)
            count = np.where(there, whole[place], 0)
        post.add(source[first], words=words[first], root_customers=root[0].T.copy(), root_tables=root[1].T.copy(), more=count)

    return _met(rows, asked, seated)


def _ask(row: dict, tables: np.ndarray, model: Model, post: _Post) -> None:
    """Tell the buckets of rare words how many tables they have in a row of rare contexts."""
    rare, customers = np.frombuffer(row["rare"], "<i8"), np.frombuffer(row["customers"], "<i8")
    at = _stepped(row["contexts"]) == _RARE
    to = model.buckets + model.bucket(rare, np.zeros(len(rare), np.int64))
    post.add(to, words=rare, source=np.full(len(rare), row["bucket"]), extra=tables[at].astype("<u4"), customers=customers[at])


def asked(rows: DataFrame, model: Model) -> DataFrame:
    """The first messages of rare contexts: a table for each cell."""

    def run(parts):
        post = _Post()

        def rows():
            for row in _rows_of(parts):
                _ask(row, np.minimum(np.frombuffer(row["customers"], "<i8"), 1), model, post)
                if post.size > _HELD:
                    yield from post.rows()
            yield from post.rows()

        yield from _batches(rows(), _EXCHANGED)

    return rows.mapInArrow(run, _EXCHANGED)


def rare_contexts_swept(rows: DataFrame, told: DataFrame, model: Model, turn: int) -> DataFrame:
    """Rows of rare contexts after the sweeps of a turn, and messages to rare words."""
    samples = SAMPLES if turn == TURNS - 1 else 1
    ways: list[np.ndarray] = []

    def seated(bucket, held, state, post):
        if state is None:
            return
        if not ways:
            ways.append(_ways(_LISTED))
        words, *root, n = _told(held, words="<i8", root_customers="<f8", root_tables="<f8", more="<i8")
        order = np.argsort(words, kind="stable")
        at = order[np.searchsorted(words[order], np.frombuffer(state["rare"], "<i8"))]
        out = _contexts_swept(state, model, turn, ways[0], *(x.reshape(-1, samples)[at].T for x in root))
        yield _exchanged(out | {"more": n[at].tobytes(), "kind": _STATE})
        if turn < TURNS - 1:
            _ask(state, _tables(out)[0], model, post)

    return _met(rows, told, seated)


def _tables(row: dict) -> np.ndarray:
    """The tables of all cells of a row, for each sample; before the first sweep, one for each cell with customers."""
    customers = np.frombuffer(row["customers"], "<i8")
    samples = np.frombuffer(row.get("samples") or b"", "<u4")
    many = customers > 1
    out = np.tile(np.minimum(customers, 1), (max(1, len(samples) // max(1, int(many.sum()))), 1))
    if row.get("samples"):
        out[:, many] = samples.reshape(len(out), -1)
    return out


def _block_sums(rows: DataFrame, height: int, size: int, add) -> np.ndarray:
    """Sums over all rows of the arrays of that height and size that ``add(array, row)`` adds to. A task sends its sums in blocks,
    so that they meet as arrays."""

    def run(parts):
        out = np.zeros((height, size))
        for row in _rows_of(parts):
            add(out, row)
        rows_ = ((b, out[:, b * _BLOCK : (b + 1) * _BLOCK].astype("<f8").tobytes()) for b in range(-(-size // _BLOCK)))
        yield from _batches((x for x in rows_ if np.frombuffer(x[1], "<f8").any()), schema)

    def summed(parts):
        block, held = None, None
        for row in _rows_of(parts):
            mine = np.frombuffer(row["sums"], "<f8")
            if row["block"] != block:
                if block is not None:
                    yield from _batches([(block, held.tobytes())], schema)
                block, held = row["block"], np.zeros(len(mine))
            held = held + mine
        if block is not None:
            yield from _batches([(block, held.tobytes())], schema)

    schema = "block int, sums binary"
    found = rows.mapInArrow(run, schema).repartition("block").sortWithinPartitions("block").mapInArrow(summed, schema).collect()
    whole = np.zeros((height, size))  # a row for each block of at most 1 / CONTEXT_SHARE numbers
    for r in found:
        sums = np.frombuffer(r["sums"], "<f8").reshape(height, -1)
        whole[:, r["block"] * _BLOCK : r["block"] * _BLOCK + sums.shape[1]] = sums
    return whole


def totals(rows: DataFrame, model: Model, samples: int, started: bool = True) -> Model:
    """``model`` with the restaurants' customers and tables summed over all words, and the root's of frequent words, for each sample."""
    size, width = model.restaurants + 1, len(model.words)

    def add(out, row):
        r = Row.of(row)
        many = r.customers > 1
        customers = np.bincount(r.context, weights=r.customers, minlength=size)
        ones = np.bincount(r.context[~many], minlength=size)
        place = _place(model.words, r.words, -1)
        for s in range(samples):
            if started:
                tables = np.frombuffer(row["samples"], "<u4").reshape(samples, -1)[s]
                each = [np.frombuffer(row[c], "<f8").reshape(samples, -1)[s] for c in ("root_customers", "root_tables")]
            else:  # a table for each cell, and for each word
                tables, each = np.ones(int(many.sum())), [np.bincount(r.word, minlength=len(r.words)), np.ones(len(r.words))]
            out[s, :size] += customers
            out[samples + s, :size] += ones + np.bincount(r.context[many], weights=tables, minlength=size)
            for i in range(2):
                out[i * samples + s, size - 1] += each[i].sum()
                out[i * samples + s, size + place[place >= 0]] += each[i][place >= 0]

    whole = _block_sums(rows, 2 * samples, size + width, add)
    roots = whole[:, size:].reshape(2, samples, width)
    return replace(model, customers=whole[:samples, :size], tables=whole[samples:, :size], roots=roots)


def from_contexts(rows: DataFrame, model: Model) -> Model:
    """``model`` with the customers that come to the root from rare contexts, in its total too."""
    size = len(model.words) + 1

    def add(out, row):
        number, tables = _stepped(row["contexts"]), _tables(row)[-1]
        known = number != _RARE
        out[0] += np.bincount(number[known], weights=tables[known], minlength=size)
        out[0, -1] += tables.sum()

    extra = _block_sums(rows, 1, size, add)[0]
    customers = model.customers.copy()
    customers[:, -1] += extra[-1] - (0 if model.extra is None else model.extra[-1])
    return replace(model, extra=extra, customers=customers)


def train(texts: DataFrame) -> tuple[DataFrame, Model]:
    """The rows of words (as in ``_SWEPT``, with ``more``) and the model, from training texts (column ``text``)."""
    rows, _, model = trained(texts.select("text", F.lit(False).alias("held")))
    return rows, model


def trained(texts: DataFrame) -> tuple[DataFrame, DataFrame, Model]:
    """The rows of words and those of rare contexts (as in ``_EXCHANGED``) and the model, from texts (column ``text``) of which some
    are held out (column ``held``)."""
    model = Model.of(_stored(word_counts(texts.filter(~F.col("held"))), "lm-counts"))
    stored = cells(texts, model)
    often = frequent(stored, model)
    seldom = stored.filter(f"bucket >= {model.buckets} AND bucket < {2 * model.buckets}").drop("rare")
    contexts = stored.filter(f"bucket >= {2 * model.buckets}")
    model = from_contexts(contexts, totals(often.unionByName(seldom), model, 1, started=False))
    messages = asked(contexts, model)
    state, message = f"kind = {_STATE}", f"kind = {_MESSAGE}"
    for turn in range(TURNS):
        samples = SAMPLES if turn == TURNS - 1 else 1
        often = _stored(swept(often, model, turn), "lm-rows")
        met = _stored(rare_words_swept(seldom, messages, model, turn), "lm-rare-words")
        seldom = met.filter(state).drop("kind", "rare", "extra", "source")
        model = totals(often.unionByName(seldom.drop("more")), model, samples)
        met = rare_contexts_swept(contexts, met.filter(message), model, turn)
        met = met if turn == TURNS - 1 else _stored(met, "lm-rare-contexts")  # the last ones are read once only
        contexts, messages = met.filter(state).drop("kind", "extra", "source"), met.filter(message)
        if turn < TURNS - 1:
            model = from_contexts(contexts, model)
    return often.unionByName(seldom, allowMissingColumns=True), contexts, model


def probabilities(row: dict, model: Model):
    """A function of words (as numbers in the row, or -1 for one that it does not have) and contexts that gives averaged predictive
    probabilities, and the training counts of the row's words."""
    r = Row.of(row)
    many = np.flatnonzero(r.customers > 1)
    tables = np.ones((SAMPLES, len(r.word)))
    tables[:, many] = np.frombuffer(row["samples"], "<u4").reshape(SAMPLES, -1)
    # the last one is that of a pair, or of a word, that there is not
    own = np.append(np.maximum(r.customers - DISCOUNT * tables, 0).sum(axis=0), 0)
    given = (np.append(np.frombuffer(row[c], "<f8").reshape(SAMPLES, -1), np.zeros((SAMPLES, 1)), axis=1) for c in ("root_customers", "root_tables"))
    roots = [model.root(*x, s) for s, x in enumerate(zip(*given))]
    cell = r.word << 20 | r.context

    def of(word: np.ndarray, context: np.ndarray) -> np.ndarray:
        each, *shares = model.shares
        total = own[_place(cell, word << 20 | context, -1)] * each[context]
        for share, root in zip(shares, roots):
            total += share[context] * root[word]
        return total / SAMPLES

    counts = np.bincount(r.word, weights=r.customers, minlength=len(r.words))
    if row.get("more"):
        counts += np.frombuffer(row["more"], "<i8")
    at = _place(model.words, r.words, -1)
    return of, np.where(at >= 0, model.counts[at], counts)


def context_probabilities(row: dict | None, model: Model):
    """As :func:`probabilities`, for a row of rare contexts (or none): a function of contexts (as numbers in the row, or -1), numbers of words
    and, where those are ``_RARE``, hashes. It gives the words' training counts too."""
    r = Row.of(row) if row else Row(*(np.zeros(0, np.int64) for _ in range(4)))
    tables = np.broadcast_to(_tables(row) if row else np.zeros((1, 0)), (SAMPLES, len(r.word)))
    # the last one is that of a pair, or of a context, that there is not
    own = np.append(np.maximum(r.customers - DISCOUNT * tables, 0).sum(axis=0), 0)
    each, *whole = (np.bincount(r.word, weights=x, minlength=len(r.words) + 1) for x in (r.customers, *tables))
    each = 1 / (STRENGTH + each)
    shares = [(STRENGTH + DISCOUNT * x) * each for x in whole]
    rare = r.context == _RARE
    at_rare, at_known = (np.append(np.flatnonzero(x), len(r.word)) for x in (rare, ~rare))
    cell = r.word[~rare] << 20 | r.context[~rare]
    hashes = np.frombuffer(row["rare"], "<i8") if row else r.words
    names, name = np.unique(hashes, return_inverse=True)
    pair = r.word[rare] * (len(names) + 1) + name
    pad = np.zeros((SAMPLES, 1))
    given = (np.append(np.frombuffer(row[c], "<f8").reshape(SAMPLES, -1), pad, axis=1) if row else pad for c in ("root_customers", "root_tables"))
    roots = [model.root(*x, s) for s, x in enumerate(zip(*given))]
    more = np.append(np.frombuffer(row["more"], "<i8") if row else r.words, 0)

    def of(context: np.ndarray, number: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total, count = np.zeros(len(context)), np.zeros(len(context), np.int64)
        for seldom in (False, True):
            mine = np.flatnonzero((number == _RARE) == seldom)
            if not len(mine):
                continue
            c, n = context[mine], number[mine]
            if seldom:
                at = _place(pair, c * (len(names) + 1) + _place(names, other[mine], len(names)), -1)
                p, root, count[mine] = own[at_rare[at]] * each[c], [x[at] for x in roots], more[at]
            else:
                p, root, count[mine] = own[at_known[_place(cell, c << 20 | n, -1)]] * each[c], model.known_roots[:, n], model.counts[n]
            for share, x in zip(shares, root):
                p += share[c] * x
            total[mine] = p
        return total / SAMPLES, count

    return of


def _numbered(parts, most: int = _PART_TEXTS):
    """Parts of the batches of a task with a number that no other part of the table has. A table that is
    read again in the same way has the same numbers."""
    number = TaskContext.get().partitionId() << 32
    for batch in parts:
        for part in batches.slices(batch, "text", _MANY_BYTES):
            for begin in range(0, part.num_rows, most):
                yield number, part.slice(begin, most)
                number += 1


class _Sums:
    """Sums of texts by part, until they are sent."""

    def __init__(self) -> None:
        self.found: dict[int, np.ndarray] = {}
        self.size = 0

    def add(self, part: int, doc: np.ndarray, unknown: np.ndarray, base: np.ndarray, model: np.ndarray) -> None:
        size = int(doc.max()) + 1
        mine = self.found.get(part, np.zeros((4, 0)))
        if mine.shape[1] < size:
            self.size += size - mine.shape[1]
            mine = np.concatenate([mine, np.zeros((4, size - mine.shape[1]))], axis=1)
        mine[0, :size] += np.bincount(doc, minlength=size)
        if unknown.any():
            mine[1, :size] += np.bincount(doc[unknown], minlength=size)
        mine[2, :size] += np.bincount(doc, weights=base, minlength=size)
        mine[3, :size] += np.bincount(doc, weights=model, minlength=size)
        self.found[part] = mine

    def rows(self):
        for part, total in self.found.items():
            doc = np.flatnonzero(total[0])
            yield part, b"".join(x.astype(kind).tobytes() for x, (_, kind) in zip((doc, *total[:, doc]), _SUM))
        self.found, self.size = {}, 0

    @staticmethod
    def unpacked(sums: bytes) -> list[np.ndarray]:
        """The texts of a row and their four sums."""
        n, at, out = len(sums) // sum(np.dtype(k).itemsize for _, k in _SUM), 0, []
        for _, kind in _SUM:
            out.append(np.frombuffer(sums, kind, n, at))
            at += out[-1].nbytes
        return out


def score(docs: DataFrame, *, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, n_known, train_tokens, base_score, score), one for each of ``docs``.

    ``base_score`` is the logarithm of an add-one model of the training tokens; ``score`` that of the
    hierarchical model.
    """
    given = docs.select(F.col(ident).alias("doc_id"), F.col(text).alias("text"))
    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    rows, contexts, model = trained(given.select("text", held_out.alias("held")))
    schema = "bucket long, part long, words binary, lengths binary, entries binary, rare binary"

    def places(parts):
        def found():
            for number, part in _numbered(parts):
                for bucket, c in _places(batches.column_bytes(part.column("text")), model, number):
                    yield bucket, number, c["words"], c["lengths"], c["entries"], c["rare"]

        yield from _batches(found(), schema)

    def dealt(parts):
        """The rows of the model in the buckets whose places need them: common words in all that have a copy."""
        yield from _batches((x for row in _rows_of(parts) for x in deal(row)), _DEALT)

    def deal(row: dict):
        r = Row.of(row)
        copies = model.copies_of(r.words)
        word = np.repeat(np.arange(len(r.words)), copies)
        copy = np.arange(len(word)) - np.repeat(np.cumsum(copies) - copies, copies)
        bucket = model.bucket(r.words[word], copy)
        if (bucket == bucket[0]).all() and len(word) == len(r.words):
            yield int(bucket[0]), *(row[c] for c in _MODEL)
            return
        lengths = np.bincount(r.word, minlength=len(r.words))
        begin = np.cumsum(lengths) - lengths
        many = r.customers > 1
        tables = np.ones((SAMPLES, len(r.word)), "<u4")
        tables[:, many] = np.frombuffer(row["samples"], "<u4").reshape(SAMPLES, -1)
        root = [np.frombuffer(row[c], "<f8").reshape(SAMPLES, -1) for c in ("root_customers", "root_tables")]
        for b in np.unique(bucket).tolist():
            mine = np.unique(word[bucket == b])
            at = np.concatenate([np.arange(begin[w], begin[w] + lengths[w]) for w in mine.tolist()])
            cells = [r.words[mine].tobytes(), lengths[mine].astype("<u4").tobytes(), _steps(r.context[at]), r.customers[at].tobytes()]
            yield b, *cells, tables[:, at][:, many[at]].tobytes(), *(x[:, mine].astype("<f8").tobytes() for x in root), None

    def sums(parts):
        held: list[tuple] = []  # what the bucket knows, a row of the model each
        bucket, found = None, _Sums()
        for row in _rows_sent(parts):
            if row["bucket"] != bucket:
                bucket, held = row["bucket"], []
            after = bucket >= 2 * model.buckets
            if row["part"] is None:
                held.append((np.frombuffer(row["words"], "<i8"), *((context_probabilities(row, model),) if after else probabilities(row, model))))
                continue
            words, lengths = np.frombuffer(row["words"], "<i8"), np.frombuffer(row["lengths"], "<u4")
            entry = np.frombuffer(row["entries"], "<u4").astype(np.int64)
            word, context, doc = np.repeat(np.arange(len(words)), lengths), entry >> 12, entry & 0xFFF
            other = np.frombuffer(row["rare"], "<i8") if row["rare"] else context
            # each pair once
            first = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (context[1:] != context[:-1]) | (other[1:] != other[:-1])))
            back = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(word))))
            word, context = word[first], context[first]
            if after:
                known, of = held[0] if held else (np.zeros(0, np.int64), context_probabilities(None, model))
                log, count = of(_place(known, words, -1)[word], context, other[first])
                base = np.log10((count + 1) / (model.trained + model.known + 1))
                found.add(row["part"], doc, (count == 0)[back], base[back], np.log10(log)[back])
                if found.size > _FLUSH:
                    yield from _batches(found.rows(), "part long, sums binary")
                continue
            count, log = np.zeros(len(words)), np.zeros(len(word))
            left = np.ones(len(words), bool)
            for known, of, counts in held:
                at = np.minimum(np.searchsorted(known, words), len(known) - 1)
                mine = known[at] == words
                count[mine] = counts[at[mine]]
                left &= ~mine
                chosen = mine[word]
                log[chosen] = np.log10(of(at[word[chosen]], context[chosen]))
            if left.any():
                chosen = left[word]
                zero = np.zeros(int(chosen.sum()))
                each = [model.context(zero, zero, context[chosen], model.root(zero, zero, s), s) for s in range(len(model.tables))]
                log[chosen] = np.log10(np.mean(each, axis=0))
            base = np.log10((count + 1) / (model.trained + model.known + 1))
            found.add(row["part"], doc, (count == 0)[word][back], base[word][back], log[back])
            if found.size > _FLUSH:
                yield from _batches(found.rows(), "part long, sums binary")
        yield from _batches(found.rows(), "part long, sums binary")

    def merged(parts):
        number, total = None, None

        def rows_():
            doc = np.flatnonzero(total[0])
            n = total[0, doc].astype(np.int64)
            columns = [pa.array(np.full(len(doc), number)), pa.array(doc.astype(np.int32)), pa.array(n), pa.array(n - total[1, doc].astype(np.int64))]
            return pa.RecordBatch.from_arrays([*columns, pa.array(total[2, doc]), pa.array(total[3, doc])], names=list(per_text))

        for row in _rows_of(parts):
            if row["part"] != number:
                if number is not None:
                    yield rows_()
                number, total = row["part"], np.zeros((4, _PART_TEXTS))
            doc, *values = _Sums.unpacked(row["sums"])
            for i, value in enumerate(values):
                total[i, doc] += value
        if number is not None:
            yield rows_()

    def names(parts):
        for number, part in _numbered(parts):
            columns = [part.column("doc_id"), pa.array(np.full(part.num_rows, number)), pa.array(np.arange(part.num_rows, dtype=np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "doc"])

    per_text = {"part": "long", "doc": "int", "n_tokens": "long", "n_known": "long", "base_score": "double", "score": "double"}
    named = given.mapInArrow(
        names, T.StructType([given.schema["doc_id"], T.StructField("part", T.LongType()), T.StructField("doc", T.IntegerType())])
    )
    heads = rows.select("bucket", *_MODEL).mapInArrow(dealt, _DEALT)
    heads = heads.unionByName(contexts.select("bucket", *_MODEL, "rare"), allowMissingColumns=True)
    both = given.mapInArrow(places, schema).unionByName(_sent(heads), allowMissingColumns=True)
    summed = (
        both.repartition("bucket")
        .sortWithinPartitions("bucket", F.col("part").asc_nulls_first())
        .mapInArrow(sums, "part long, sums binary")
        .repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(merged, ", ".join(f"{name} {kind}" for name, kind in per_text.items()))
    )
    return named.join(summed, ["part", "doc"]).select(
        "doc_id", "n_tokens", "n_known", F.lit(model.trained).cast("long").alias("train_tokens"), "base_score", "score"
    )


_MODEL = ("words", "lengths", "contexts", "customers", "samples", "root_customers", "root_tables", "more")
_DEALT = "bucket long, " + ", ".join(f"{c} binary" for c in _MODEL)
