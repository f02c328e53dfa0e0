"""Near duplicates by SimHash: fingerprints, links within a Hamming radius, connected groups.

A fingerprint has a bit set if over half of the 64-bit hashes of a text's word shingles have it. Links
are sought between distinct fingerprints. Two within the radius agree on at least one of radius + 1
blocks of bits, so each fingerprint goes to radius + 1 places, one for each block's value, and
each place is searched with the Gray-order index of :mod:`gray_index`. Places with very many
fingerprints are dealt again by other blocks, by the same rule, so no link is lost. A place emits links that
span its groups, not all pairs; the groups of all places are joined by alternating star rounds.

Defined results: a null text is empty; a text without words has fingerprint zero, linked like any
other; equal texts have equal fingerprints and one group; a group's id is its least doc_id, null if none
of its rows has one; extra columns are kept.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sizing import broadcast_if_small
from ..session import materialize
from . import batches, gray_index
from .text import private

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(batches)
cloudpickle.register_pickle_by_value(gray_index)

WORDS_PER_SHINGLE = 4
RADIUS = 4
SEED = 42
#: Places with more distinct fingerprints than this are dealt again, this often.
CROWD = 100_000
DEALS = 3

_LOWER_CASE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprints_of(texts: list[bytes], words_per_shingle: int = WORDS_PER_SHINGLE) -> list[int]:
    """The SimHash of each text, unsigned. A text with fewer words has one shingle, all its words."""
    import numpy as np
    import xxhash

    digest, out = xxhash.xxh64_intdigest, []
    for text in texts:
        words = text.translate(_LOWER_CASE).split()
        if not words:
            out.append(0)
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        last = min(words_per_shingle, len(words)) - 1
        spans = zip(starts[: len(words) - last].tolist(), ends[last:].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        counts = np.zeros(64, dtype=np.int64)
        for i in range(0, len(hashes), 1 << 14):
            bits = np.unpackbits(hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int32)
        out.append(sum(1 << i for i in np.flatnonzero(counts * 2 > len(hashes)).tolist()))
    return out


def with_fingerprint(
    docs: DataFrame, text: str = "text", name: str = "fingerprint", words_per_shingle: int = WORDS_PER_SHINGLE
) -> DataFrame:
    """``docs`` without ``text``, with the fingerprint as a signed 64-bit number."""
    kept = [c for c in docs.columns if c not in (text, name)]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(name, T.LongType())])

    def run(parts):
        for batch in parts:
            prints = []
            for part in batches.slices(batch, text):
                prints += fingerprints_of(batches.column_bytes(part.column(text)), words_per_shingle)
            signed = pa.array([p - (1 << 64) if p >> 63 else p for p in prints], pa.int64())
            columns = [batch.column(c) for c in kept] + [signed]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, name])

    return docs.select(*(F.col(f"`{c}`") for c in [*kept, text])).mapInArrow(run, schema)


def gray_rank(fingerprint: Column) -> Column:
    """The place of a fingerprint among all in Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        fingerprint = fingerprint.bitwiseXOR(F.shiftrightunsigned(fingerprint, shift))
    return fingerprint


def _masks(deal: int, blocks: int) -> list[int]:
    """Masks of ``blocks`` disjoint sets of bits, all 64 together, as signed numbers; other sets for
    each deal."""
    step = (1, 19, 27, 45)[deal % 4]  # odd, so that its multiples visit every bit
    of_bit = [(i * step % 64) * blocks // 64 for i in range(64)]
    masks = [sum(1 << i for i in range(64) if of_bit[i] == b) for b in range(blocks)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _places(prints: DataFrame, radius: int, crowd: int) -> DataFrame:
    """Rows (place, print): every two fingerprints within the radius share a place."""

    def dealt(df: DataFrame, deal: int) -> DataFrame:
        keys = [F.xxhash64("place", F.lit(i), F.col("print").bitwiseAND(m)) for i, m in enumerate(_masks(deal, radius + 1))]
        return df.select(F.explode(F.array(*keys)).alias("place"), "print")

    places = dealt(prints.withColumn("place", F.lit(0).cast("long")), 0)
    for deal in range(1, DEALS + 1):
        crowded = materialize(places.groupBy("place").count().filter(F.col("count") > crowd).select("place"), "simhash-crowds")
        if crowded.isEmpty():
            break
        again = dealt(places.join(crowded, "place", "left_semi"), deal)
        places = materialize(places.join(crowded, "place", "left_anti").unionByName(again), "simhash-places")
    return places


def links(prints: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Rows (a, b) that connect all distinct fingerprints (column ``print``) connected within ``radius``."""

    def run(parts):
        import numpy as np

        def found(place: np.ndarray, print_: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
            a, b = gray_index.spanning_links(print_, starts, radius)
            return pa.RecordBatch.from_arrays([pa.array(print_[x].view(np.int64)) for x in (a, b)], names=["a", "b"])

        held_place, held_print = [], []
        for batch in parts:
            if not batch.num_rows:
                continue
            place = batch.column("place").to_numpy()
            print_ = batch.column("print").to_numpy().view(np.uint64)
            last = int(np.searchsorted(place, place[-1]))  # the last place may go on in the next batch
            if last or (held_place and held_place[-1][-1] != place[0]):
                cut = last
                if held_place and held_place[-1][-1] != place[0]:
                    yield found(np.concatenate(held_place), np.concatenate(held_print))
                    held_place, held_print = [], []
                if cut:
                    yield found(np.concatenate([*held_place, place[:cut]]), np.concatenate([*held_print, print_[:cut]]))
                    held_place, held_print = [], []
                place, print_ = place[cut:], print_[cut:]
            held_place.append(place)
            held_print.append(print_)
        if held_place:
            yield found(np.concatenate(held_place), np.concatenate(held_print))

    order = gray_rank(F.col("print")).bitwiseXOR(F.lit(-(2**63)))  # unsigned order
    return (
        _places(prints, radius, crowd)
        .repartition("place")
        .sortWithinPartitions("place", order)
        .mapInArrow(run, "a long, b long")
        .distinct()
    )


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for all nodes of the edges but the roots, the least node of each component.

    Alternating star rounds: each node sends its larger neighbours, then all its neighbours, to its
    least one. The least neighbour is a partial aggregate, and the joins are plain ones, whose hot keys
    adaptive execution can split. Each round starts from written rows.
    """
    stars = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "simhash-stars"
    )
    before = None
    while True:
        state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "simhash-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        stars = materialize(small, "simhash-stars")


def components(printed: DataFrame, ident: str = "doc_id", name: str = "fingerprint", radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Rows (print, root, component_id): the group of each distinct fingerprint and its least id.

    ``printed`` is read twice, so it should be stored.
    """
    prints = materialize(
        printed.groupBy(F.col(name).alias("print")).agg(F.min(ident).alias("least")), "simhash-prints"
    )
    roots = connected(links(prints.select("print"), radius, crowd))
    rooted = prints.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    rooted = materialize(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("print", "root", "component_id")


def one_of_each(docs: DataFrame, *, ident: str = "doc_id", text: str = "text", words_per_shingle: int = WORDS_PER_SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group: that of the least id, ties by a hash of the text and of the row.

    The decision is made on a narrow table (id, hashes of the text and of the row, fingerprint). Rows that go, few as a
    rule, leave by an anti join with it, so that texts are not shuffled while their keys can be broadcast. Of equal
    rows that stay, one is taken in a second pass, if there are any.
    """
    key, content, whole, rank = (private(docs, f"simhash_{c}") for c in ("key", "content", "whole", "rank"))
    row_hash = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    narrow = docs.select(F.col(ident).alias("key"), F.xxhash64(F.col(text)).alias("content"), row_hash.alias("whole"), F.col(text).alias("text"))
    printed = materialize(with_fingerprint(narrow, "text", "print_of", words_per_shingle), "simhash-narrow")
    groups = components(printed, "key", "print_of", radius).select("print", "root")
    rows = printed.groupBy("print_of", "key", "content", "whole").agg((F.count(F.lit(1)) > 1).alias("again"))
    own = F.struct(F.col("key").isNull().alias("none"), "key", "content", "whole")
    placed = rows.join(groups, F.col("print_of") == F.col("print")).select("root", own.alias("own"), "again")
    placed = materialize(placed, "simhash-placed")
    first = materialize(placed.groupBy("root").agg(F.min("own").alias("first")), "simhash-first")
    stays = F.col("own").eqNullSafe(F.col("first"))
    gone = placed.join(first, "root").filter(~stays | F.col("again")).select(
        F.col("own.key").alias(key), F.col("own.content").alias(content), F.col("own.whole").alias(whole), stays.alias(rank)
    )
    gone = materialize(gone, "simhash-gone")
    same = F.col(ident).eqNullSafe(F.col(key)) & (F.xxhash64(F.col(text)) == F.col(content)) & (row_hash == F.col(whole))
    kept = docs.join(broadcast_if_small(gone.drop(rank)), same, "left_anti")
    repeated = gone.filter(rank).drop(rank)
    if repeated.isEmpty():
        return kept
    one = Window.partitionBy(ident, F.xxhash64(F.col(text)), row_hash).orderBy(row_hash)
    once = docs.join(broadcast_if_small(repeated), same, "left_semi").withColumn(rank, F.row_number().over(one))
    return kept.union(once.filter(F.col(rank) == 1).drop(rank))
