"""Near duplicates by MinHash: universal hash minima, bands, signatures, exact sets, connected components.

A text's set is that of its word shingles, as 64-bit hashes. Texts of one set are one node from the start. A node's
signature has the minima of the set under many universal hash functions; nodes that agree on all rows of a band meet
in a bucket. The number of bands follows from the threshold, so that a link is missed with a probability of at
most ``MISS``.

Not all pairs of a bucket are made. The members of a bucket are compared, by signature, with its least member; buckets whose
members are not joined in this way are searched for more such links, in blocks of bounded size, and send links that span what is
joined. Nodes joined by signatures are a family; a true link lies within one, since its signatures agree by at
least the threshold less ``SIGMAS`` deviations. The whole sets of a family are compared exactly, in blocks of bounded size that
meet in pairs, and links that span its components are sent. Components of these are found by alternating stars.

Defined results: a text with fewer words than a shingle has one shingle, all its words; one without words, or null, has an empty set and is
linked with nothing; a component's id is the least id of its rows, null if none has one; repeated rows and ids are rows
of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sizing import broadcast_if_small
from ..session import materialize
from . import batches
from .stars import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(batches)

ROWS = 5  # minima in a band
MISS = 1e-8  # probability that a pair at the threshold shares no bucket
SIGMAS = 6  # by which signatures of a link may fall short
SEED = 11
BLOCK_NODES = 2048  # of a bucket, as signatures
BLOCK_SHINGLES = 1 << 20  # of a family, as whole sets

_SALT = 0x9E3779B97F4A7C15


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands of ``rows`` minima after which a pair of that similarity is missed with a probability of ``miss``."""
    return max(1, math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows)))) if percent < 100 else 1


def least_agreement(percent: int, hashes: int) -> float:
    """The agreement of signatures below which no link lies."""
    t = percent / 100
    return t - SIGMAS * math.sqrt(t * (1 - t) / hashes)


def sets_of(texts: list[bytes], words_per_shingle: int) -> list[np.ndarray]:
    """The distinct shingles of each text, as sorted 64-bit hashes."""
    words = batches.Words(texts, by_space=True)
    hashes, first = words.hash, words.first
    out = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        n = end - begin
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        k = min(n, words_per_shingle)
        joined = np.full(n - k + 1, k if k < words_per_shingle else 0, np.uint64)
        for i in range(k):
            joined = batches.mix64(joined * np.uint64(_SALT) + hashes[begin + i : end - k + 1 + i])
        out.append(np.unique(joined))
    return out


def hash_functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and summands of functions a * x + b modulo 2 ** 32."""
    draw = np.random.default_rng(SEED)
    return draw.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), draw.integers(0, 1 << 32, n, dtype=np.uint32)


def signature(shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The low 16 bits of the minimum under each function."""
    a, b = (x[:, None] for x in functions)
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(len(functions[0]), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 4096):
        np.minimum(least, (a * x[None, at : at + 4096] + b).min(axis=1), out=least)
    return least.astype("<u2")


def described(docs: DataFrame, ident: str, text: str, words_per_shingle: int, hashes: int) -> DataFrame:
    """Rows (doc_id, row_key, n_shingles, high, low, signature) for all ``docs``: the 128 bits are those of the set."""
    functions = hash_functions(hashes)
    given = docs.select(F.col(ident).alias("doc_id"), F.xxhash64(F.col(ident), F.col(text)).alias("row_key"), F.col(text).alias("text"))
    schema = T.StructType(
        [given.schema["doc_id"], given.schema["row_key"]]
        + [T.StructField(n, T.LongType()) for n in ("n_shingles", "high", "low")]
        + [T.StructField("signature", T.BinaryType())]
    )

    def run(parts):
        for batch in parts:
            for part in batches.slices(batch, "text"):
                sets = sets_of(batches.column_bytes(part.column("text")), words_per_shingle)
                sums = [np.array([int(batches.mix64(s + np.uint64(salt)).sum(dtype=np.uint64)) for s in sets], np.uint64).view(np.int64) for salt in (1, 2)]
                columns = [part.column("doc_id"), part.column("row_key"), pa.array([len(s) for s in sets], pa.int64()), *map(pa.array, sums)]
                columns.append(pa.array([signature(s, functions).tobytes() if len(s) else None for s in sets], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return given.mapInArrow(run, schema)


def _signatures(column: pa.Array) -> np.ndarray:
    """A signature a row."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), "<u2").reshape(len(values), -1)


def buckets(nodes: DataFrame, hashes: int) -> DataFrame:
    """Rows (key, node, leader, members) of all buckets with two nodes or more; the leader is the least node."""

    def run(parts):
        for batch in parts:
            if not batch.num_rows:
                continue
            signatures = _signatures(batch.column("signature")).astype(np.uint64)
            node = np.asarray(batch.column("node"))
            keys = []
            for band in range(hashes // ROWS):
                key = np.full(len(node), band, np.uint64)
                for i in range(band * ROWS, band * ROWS + ROWS):
                    key = batches.mix64(key * np.uint64(_SALT) + signatures[:, i])
                keys.append(key.view(np.int64))
            columns = [pa.array(np.concatenate(keys)), pa.array(np.tile(node, len(keys)))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "node"])

    banded = nodes.select("node", "signature").mapInArrow(run, "key long, node long")
    crowds = banded.groupBy("key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    crowds = materialize(crowds.select(F.col("key").alias("bucket"), "leader", "members"), "minhash-crowds")
    same = (F.col("key") == F.col("bucket")) & (F.xxhash64("key") == F.xxhash64("bucket"))
    return banded.join(broadcast_if_small(crowds), same).select("key", "node", "leader", "members")


def agreeing(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose signatures agree on a share of at least ``least``."""
    side = lambda n: nodes.select(F.col("node").alias(n), F.col("signature").alias(f"signature_{n}"))

    def run(parts):
        for batch in parts:
            if not batch.num_rows:
                continue
            same = _signatures(batch.column("signature_a")) == _signatures(batch.column("signature_b"))
            chosen = pa.array(same.mean(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(chosen) for c in ("a", "b")], names=["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def _blocks(rows: DataFrame, key: str, blocks: str, node: str = "node") -> DataFrame:
    """``rows`` with (low, high), once for each pair of blocks of their ``key`` that holds them. ``blocks`` is the number of
    blocks; nodes are dealt to them by hash."""
    mine = F.pmod(F.xxhash64(node), F.col(blocks)).cast("int")
    last = (F.col(blocks) - 1).cast("int")
    low_high = F.when(last == 0, F.array(F.struct(F.lit(0).alias("low"), F.lit(0).alias("high")))).otherwise(
        F.transform(
            F.filter(F.sequence(F.lit(0), last), lambda i: i != F.col("own")),
            lambda i: F.struct(F.least(i, F.col("own")).alias("low"), F.greatest(i, F.col("own")).alias("high")),
        )
    )
    dealt = rows.withColumn("own", mine).withColumn("square", F.explode(low_high))
    return dealt.select("*", "square.low", "square.high").drop("square", "own")


def _groups(parts, key: list[str], take):
    """``take`` gets the rows of each key (a table) from a sorted stream, and gives two arrays: the ends of links."""
    held, name = [], None

    def done():
        a, b = take(pa.Table.from_batches(held))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in parts:
        if not batch.num_rows:
            continue
        names = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in key])
        first = np.flatnonzero(np.append(True, (names[:, 1:] != names[:, :-1]).any(axis=0)))
        for begin, end in zip(first.tolist(), [*first[1:].tolist(), batch.num_rows]):
            own = tuple(names[:, begin].tolist())
            if held and own != name:
                yield done()
                held = []
            name = own
            held.append(batch.slice(begin, end - begin))
    if held:
        yield done()


def spanning(n: int, label: np.ndarray, linked) -> tuple[list[int], list[int]]:
    """Links that join what is connected among ``n`` members, those of one label being so from the start.

    ``linked(i, others)`` tells which of ``others`` are linked with i. From a member, all members not reached yet
    are tried; what is reached is tried in turn, so each pair is compared at most once, and none of two that are joined already.
    """
    a, b = [], []
    left = np.ones(n, bool)
    order = np.argsort(label, kind="stable")
    sorted_ = label[order]

    def same(i: int) -> np.ndarray:
        lo, hi = np.searchsorted(sorted_, label[i]), np.searchsorted(sorted_, label[i], side="right")
        return order[lo:hi]

    for start in range(n):
        if not left[start]:
            continue
        queue = same(start).tolist()
        left[queue] = False
        while queue:
            i = queue.pop()
            others = np.flatnonzero(left)
            if not len(others):
                return a, b
            hit = others[linked(i, others)]
            for j in hit.tolist():
                if left[j]:
                    a.append(i)
                    b.append(j)
                    more = same(j)
                    left[more] = False
                    queue += more.tolist()
    return a, b


def more_links(members: DataFrame, labels: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Links by signature within buckets whose members ``labels`` does not join (rows (node, root))."""
    marked = members.join(labels, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
    marked = materialize(marked.filter("members > 2"), "minhash-marked")  # both of two have been compared
    open_ = marked.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    open_ = open_.select(F.col("key").alias("bucket"))
    same = (F.col("key") == F.col("bucket")) & (F.xxhash64("key") == F.xxhash64("bucket"))
    rows = marked.join(open_, same, "left_semi").join(nodes.select("node", "signature"), "node")
    rows = rows.withColumn("blocks", F.ceil(F.col("members") / BLOCK_NODES))
    place = ["key", "low", "high"]

    def take(group: pa.Table):
        signatures = _signatures(group.column("signature").combine_chunks())
        node, label = (np.asarray(group.column(c)) for c in ("node", "label"))
        a, b = spanning(len(node), label, lambda i, others: (signatures[others] == signatures[i]).mean(axis=1) >= least)
        return node[a], node[b]

    blocked = _blocks(rows, "key", "blocks").select(*place, "node", "label", "signature")
    return blocked.repartition(*place).sortWithinPartitions(*place).mapInArrow(lambda parts: _groups(parts, place, take), "a long, b long")


def links(docs: DataFrame, family: DataFrame, nodes: DataFrame, ident: str, text: str, words_per_shingle: int, percent: int) -> DataFrame:
    """Links (a, b) that span the components of nodes whose whole sets are similar. ``family``: rows (node, root)
    for all but the least member of each family."""
    families = materialize(family.select("root", "node").unionByName(family.select("root", F.col("root").alias("node")).distinct()), "minhash-families")
    known = families.join(nodes.select("node", "doc_id", "row_key", "n_shingles"), "node")
    known = materialize(known.withColumnRenamed("doc_id", "own_id").withColumnRenamed("row_key", "own_key"), "minhash-members")
    sizes = known.groupBy("root").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).alias("blocks"))

    key = F.xxhash64(F.col(ident), F.col(text))
    texts = docs.select(F.col(ident).alias("doc_id"), key.alias("row_key"), F.col(text).alias("text"))
    wanted = known.select("node", "root", "own_id", "own_key")
    found = texts.join(
        broadcast_if_small(wanted), (F.col("row_key") == F.col("own_key")) & F.col("doc_id").eqNullSafe(F.col("own_id"))
    ).dropDuplicates(["node"])  # a row that the table repeats is one node

    def shingles(parts):
        for batch in parts:
            for part in batches.slices(batch, "text"):
                sets = sets_of(batches.column_bytes(part.column("text")), words_per_shingle)
                columns = [part.column(c) for c in ("root", "node")] + [pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["root", "node", "shingles"])

    place = ["root", "low", "high"]

    def take(group: pa.Table):
        node = np.asarray(group.column("node"))
        sets = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
        n = np.array([len(s) for s in sets])
        value, at = np.unique(np.concatenate(sets), return_inverse=True)
        bounds = np.append(0, np.cumsum(n))
        marked = np.zeros(len(value), bool)

        def linked(i: int, others: np.ndarray) -> np.ndarray:
            likely = 100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i])
            out = np.zeros(len(others), bool)
            chosen = others[likely]
            if len(chosen):
                mine = at[bounds[i] : bounds[i + 1]]
                marked[mine] = True
                if len(chosen) * 2 > len(n):
                    common = np.add.reduceat(marked[at], bounds[:-1], dtype=np.int64)[chosen]
                else:
                    common = np.array([np.count_nonzero(marked[at[bounds[j] : bounds[j + 1]]]) for j in chosen.tolist()])
                marked[mine] = False
                out[likely] = 100 * common >= percent * (n[chosen] + n[i] - common)
            return out

        a, b = spanning(len(node), np.arange(len(node)), linked)
        return node[a], node[b]

    sets = found.select("root", "node", "text").mapInArrow(shingles, "root long, node long, shingles binary")
    same = (F.col("root") == F.col("of")) & (F.xxhash64("root") == F.xxhash64("of"))
    dealt = sets.join(broadcast_if_small(sizes.withColumnRenamed("root", "of")), same)
    blocked = _blocks(dealt, "root", "blocks").select(*place, "node", "shingles")
    return blocked.repartition(*place).sortWithinPartitions(*place).mapInArrow(lambda parts: _groups(parts, place, take), "a long, b long")


def near_duplicates(docs: DataFrame, *, ident: str = "doc_id", text: str = "text", words_per_shingle: int = 5, percent: int = 80) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each of ``docs``: texts are linked if the shingles they share are at
    least ``percent`` of a hundred of those of both; of each component the rows with the least id are kept."""
    hashes = bands_for(percent) * ROWS
    least = least_agreement(percent, hashes)
    rows = described(docs, ident, text, words_per_shingle, hashes).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "minhash-rows")
    set_ = ["n_shingles", "high", "low"]
    classes = rows.filter("n_shingles > 0").groupBy(*set_).agg(F.min("row").alias("node"), F.min("doc_id").alias("least"))
    classes = materialize(classes, "minhash-classes")
    nodes = classes.select("node").join(rows.select(F.col("row").alias("node"), "doc_id", "row_key", "n_shingles", "signature"), "node")
    nodes = materialize(nodes, "minhash-nodes")

    members = materialize(buckets(nodes, hashes), "minhash-buckets")
    pairs = members.filter("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    family = components(agreeing(pairs, nodes, least))
    more = materialize(more_links(members, family, nodes, least), "minhash-links")
    if not more.isEmpty():
        family = components(more.unionByName(family.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    roots = components(links(docs, family, nodes, ident, text, words_per_shingle, percent))

    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = materialize(rooted, "minhash-roots")
    of_component = rooted.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "of")
    same = (F.col("root") == F.col("of")) & (F.xxhash64("root") == F.xxhash64("of"))
    named = rooted.join(of_component, same).select(*(F.col(c).alias(f"set_{c}") for c in set_), "component_id", F.lit(True).alias("known"))
    alike = [F.col(c) == F.col(f"set_{c}") for c in set_] + [F.xxhash64(*set_) == F.xxhash64(*(f"set_{c}" for c in set_))]
    joined = rows.join(named, alike, "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
