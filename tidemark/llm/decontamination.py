"""Find benchmark items in documents: windows of an item's size, SimHash, exact similarity.

For each item the windows of as many words as the item has are fingerprinted, all 64 bits from running
sums over the hashes of their five-word shingles. Items are found in a multi-index: 64 bits are eight
blocks of eight, and two fingerprints within 23 bits differ in at most two bits of one block, so the items
near each block's value are all items within the radius. Candidates are then compared exactly: the
weighted Jaccard similarity of counted shingles must reach the threshold. (Texts at a similarity of 0.8
differ in 10 of 64 bits on average, with a standard deviation of 3.)

A window that shares no shingle with any item has similarity 0, so only windows around shared shingles
are fingerprinted, and only for the sizes of items that have the shingle.

Items are the small side. They are collected and sent to the tasks in parts of bounded size, one pass
over the documents for each part; documents are neither shuffled nor cut.

Words are runs of ASCII letters and digits and of bytes beyond ASCII; A-Z and accented Latin capitals are
folded. Defined results: null and empty texts and items match nothing; an item of fewer than five words is one
shingle; a text shorter than an item is one window; repeated items and documents are each reported; extra
columns are kept by :func:`without_matches`.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(batches)

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = 8
RADIUS = 23
#: Bytes of items that go to a task at once.
PART_BYTES = 4 << 20

_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` words in a row."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        out = out * _STEP + words[i : i + n]
    return batches.mix64(out)


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set among the first 0, 1, 2, ... hashes."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    return sums


def majority(sums: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints from bit counts of windows with ``size`` shingles."""
    return np.packbits(sums * 2 > size, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


@dataclass
class Sized:
    """The items of one size: their places among all, fingerprints, shingle counts, and for each block
    and value which of them are near."""

    items: np.ndarray
    prints: np.ndarray
    counts: list[dict[int, int]]
    near: np.ndarray


class Items:
    """A part of the benchmark, as an index."""

    def __init__(self, ids: list, texts: list[bytes], radius: int = RADIUS) -> None:
        self.ids = ids
        words = batches.Words(texts)
        own = [words.hash[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(own):
            if len(w):
                by_size.setdefault(len(w), []).append(i)
        self.radius, self.sized, owners = radius, {}, {}
        values = np.arange(256, dtype=np.uint8)
        for size, members in by_size.items():
            k = min(SHINGLE, size)
            hashes = [shingles(own[i], k) for i in members]
            prints = np.array([majority(bit_sums(h)[-1:], len(h))[0] for h in hashes], dtype=np.uint64)
            blocks = prints.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
            near = np.bitwise_count(values[None, :, None] ^ blocks.T[:, None, :]) <= radius // BLOCKS
            counts = [dict(zip(*(x.tolist() for x in np.unique(h, return_counts=True)))) for h in hashes]
            self.sized[size] = Sized(np.array(members), prints, counts, near)
            for h in hashes:
                for x in h.tolist():
                    owners.setdefault((k, x), set()).add(size)
        # Per shingle length: sorted hashes, the sizes of the items that have each, and a bit table in front.
        self.anchors = {}
        for k in sorted({k for k, _ in owners}):
            known = np.array(sorted(x for l, x in owners if l == k), dtype=np.uint64)
            table = np.zeros(1 << 20, dtype=bool)
            table[known >> np.uint64(44)] = True
            self.anchors[k] = (known, [sorted(owners[k, x]) for x in known.tolist()], table)

    def matches(self, texts: list[bytes], similarity: float = SIMILARITY) -> list[tuple[int, int, float, int, int]]:
        """(text, item, similarity, distance, first word) of the best window of each pair that matches."""
        words, best = batches.Words(texts), {}
        for k, (known, sizes, table) in self.anchors.items():
            hashes = shingles(words.hash, k)
            if not len(hashes):
                continue
            maybe = np.flatnonzero(table[hashes >> np.uint64(44)])
            place = np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)
            sure = known[place] == hashes[maybe]
            at, place = maybe[sure], place[sure]
            inside = words.doc[at] == words.doc[at + k - 1]  # not across two texts
            at, place = at[inside], place[inside]
            starts = np.flatnonzero(np.append(True, np.diff(words.doc[at]) != 0)) if len(at) else []
            for a, b in zip(starts, [*starts[1:], len(at)]):
                doc = int(words.doc[at[a]])
                begin, end = int(words.first[doc]), int(words.first[doc + 1])
                own = hashes[begin : end - k + 1]
                for size in sorted({s for p in set(place[a:b].tolist()) for s in sizes[p]}):
                    hit = [i - begin for i, p in zip(at[a:b].tolist(), place[a:b].tolist()) if size in sizes[p]]
                    for item, *found in self._windows(own, np.array(hit), size, k, similarity):
                        key = (doc, item)
                        if key not in best or (-found[0], found[2]) < (-best[key][0], best[key][2]):
                            best[key] = found
        return [(*key, *found) for key, found in sorted(best.items())]

    def _windows(self, own: np.ndarray, hits: np.ndarray, size: int, k: int, similarity: float):
        """Windows of ``size`` words around the shared shingles ``hits`` that match an item of that size."""
        span = min(size - k + 1, len(own))  # shingles in a window
        last = len(own) - span
        reach = np.zeros(last + 2, dtype=np.int64)
        np.add.at(reach, np.clip(hits - span + 1, 0, last), 1)
        np.add.at(reach, np.clip(hits, 0, last) + 1, -1)
        windows = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
        low = windows[0]
        of = self.sized[size]
        for part in np.array_split(windows, len(windows) // 20000 + 1):
            low, high = part[0], part[-1] + span
            sums = bit_sums(own[low:high])
            prints = majority(sums[part - low + span] - sums[part - low], span)
            blocks = prints.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
            near = np.zeros((len(part), len(of.items)), dtype=bool)
            for b in range(BLOCKS):
                near |= of.near[b][blocks[:, b]]
            for w, j in np.argwhere(near).tolist():
                distance = int(np.bitwise_count(prints[w] ^ of.prints[j]))
                if distance <= self.radius:
                    found = self._similarity(own[part[w] : part[w] + span], of.counts[j], size - k + 1)
                    if found >= similarity:
                        yield int(of.items[j]), found, distance, int(part[w])

    @staticmethod
    def _similarity(window: np.ndarray, counts: dict[int, int], total: int) -> float:
        left, both = dict(counts), 0
        for x in window.tolist():
            if left.get(x, 0):
                left[x] -= 1
                both += 1
        return both / (len(window) + total - both)


def _parts(items: DataFrame, ident: str, text: str, part_bytes: int) -> list[Items]:
    """Indexes over parts of the items, each of about ``part_bytes``."""
    size = F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64)
    n = -(-(items.agg(size).first()[0] or 0) // part_bytes)
    for part in range(n):
        mine = items.filter(F.pmod(F.xxhash64(ident, text), F.lit(n)) == part) if n > 1 else items
        rows = sorted(mine.select(ident, text).collect(), key=lambda r: (r[0] is None, r[0], r[1] or ""))
        yield Items([r[0] for r in rows], [(r[1] or "").encode() for r in rows])


def matches(docs: DataFrame, items: DataFrame, *, ident: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows (doc_id, item_id, similarity, distance, first_word): for each document and item that
    match, the best window. ``distance`` is that of the fingerprints."""
    schema = docs.select(F.col(ident).alias("doc_id")).schema
    schema = schema.add(items.select(F.col(item).alias("item_id")).schema["item_id"])
    schema = schema.add("similarity", T.DoubleType()).add("distance", T.IntegerType()).add("first_word", T.LongType())
    found = None
    for index in _parts(items, item, item_text, part_bytes):

        def run(parts, index=index):
            for batch in parts:
                for part in batches.slices(batch, "text"):
                    rows = index.matches(batches.column_bytes(part.column("text")), similarity)
                    doc, item_no, like, distance, first = zip(*rows) if rows else [()] * 5
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id").take(pa.array(doc, pa.int64())),
                            pa.array([index.ids[i] for i in item_no], id_type),
                            pa.array(like, pa.float64()),
                            pa.array(distance, pa.int32()),
                            pa.array(first, pa.int64()),
                        ],
                        names=["doc_id", "item_id", "similarity", "distance", "first_word"],
                    )

        id_type = _arrow_type(items.schema[item].dataType)
        one = docs.select(F.col(ident).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
        found = one if found is None else found.unionByName(one)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def _arrow_type(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def without_matches(docs: DataFrame, items: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` without the rows that match an item; rows are neither shuffled nor joined."""
    for index in _parts(items, item, item_text, part_bytes):

        def run(parts, index=index):
            for batch in parts:
                for part in batches.slices(batch, text):
                    found = index.matches(batches.column_bytes(part.column(text)), similarity)
                    keep = np.ones(part.num_rows, dtype=bool)
                    keep[[f[0] for f in found]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
