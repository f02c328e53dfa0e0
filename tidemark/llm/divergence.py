"""How the sources of a language differ in their words, by in-mapper stripes.

A task folds whole documents into a hash of stripes: for each language and term the number of documents and a
hash of counts by source. A full hash is spilled as rows; stripes of one term meet by key and are
merged, so a term costs a row per spill, however often it occurs. Merged stripes of kept terms (in at least
``MIN_DOCUMENTS`` documents of the language) give the totals of each source, and, read once more with these, the
divergences: every pair of sources is compared over all kept terms, and every source with its language.

With count c of a term, N of all kept terms and V kept terms, p = 1 + floor(1e9 * (c + 5) / (N + 5 * V)), in whole
numbers (exact up to 2e14 words in a language). A pair of sources differs by the sum of |p - q|.

Sources of a language are compared in blocks of ``BLOCK``, so that a task holds a square of sums of bounded size;
with one block, no stripe is copied. A stripe in which no source of two blocks occurs is not sent to them: what
it adds is the same for all such terms.

Defined results: null text, language and source are empty; a language without kept terms has pairs of value 0; repeated rows
and ids are documents of their own; ties are ordered by the bytes of the item; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from ..session import materialize
from . import batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(batches)

MIN_DOCUMENTS = 30
SCALE, PRIOR = 1_000_000_000, 5
CELLS = 1 << 20  # counts by term and source that a task holds before it spills
BLOCK = 256  # sources
TOP_TERMS = 50

#: Terms are runs of ASCII letters and of anything beyond ASCII: A-Z in lower case, every other byte a space.
_TERMS_ONLY = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_STRIPES = "lang string, term string, documents long, sources array<string>, counts array<long>"


class Stripes:
    """(language, term) -> documents and counts by source, of the texts of a task: terms and (language, source) groups
    are numbered as they come, cells are sorted arrays of numbers."""

    def __init__(self) -> None:
        self.terms: dict[bytes, int] = defaultdict(count().__next__)
        self.groups: dict[tuple[str, str], int] = defaultdict(count().__next__)
        self.langs: dict[str, int] = defaultdict(count().__next__)
        self.cells = self.documents = (np.zeros(0, np.int64), np.zeros(0, np.int64))  # by term and group, by term and language
        self.new: list[tuple] = []

    def fold(self, texts: list[bytes], langs: list[str], sources: list[str]) -> None:
        split = [text.translate(_TERMS_ONLY).split() for text in texts]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        term = np.fromiter(map(self.terms.__getitem__, chain.from_iterable(split)), np.int64, int(lengths.sum()))
        group = np.array([self.groups[g] for g in zip(langs, sources)], dtype=np.int64)
        lang = np.array([self.langs[x] for x in langs], dtype=np.int64)
        doc = np.repeat(np.arange(len(split)), lengths)
        pair, n = np.unique(doc << 32 | term, return_counts=True)  # the terms of each document
        doc, term = pair >> 32, pair & 0xFFFFFFFF
        self.new.append((term << 24 | group[doc], n, term << 24 | lang[doc], np.ones(len(n), np.int64)))
        if sum(len(x[0]) for x in self.new) > len(self.cells[0]):
            self._settle()

    def _settle(self) -> None:
        keys, n, of_lang, docs = (np.concatenate(x) for x in zip((*self.cells, *self.documents), *self.new)) if self.new else (*self.cells, *self.documents)
        self.new, self.cells, self.documents = [], _summed(keys, n), _summed(of_lang, docs)

    def size(self) -> int:
        return len(self.cells[0]) + sum(len(x[0]) for x in self.new)

    def spill(self) -> pa.RecordBatch:
        """All stripes as rows; nothing is held afterwards."""
        self._settle()
        names = list(self.groups)
        lang_of = np.array([self.langs[lang] for lang, _ in names], dtype=np.int64)
        key, n = self.cells
        group = key & 0xFFFFFF
        stripe = key >> 24 << 24 | lang_of[group] if len(key) else key
        order = np.argsort(stripe, kind="stable")
        stripe, group, n = stripe[order], group[order], n[order]
        first = _firsts(stripe)
        of = stripe[first]  # in the order of self.documents
        sources = pa.array([s for _, s in names], pa.string()).take(pa.array(group))
        row = _rows(
            pa.array(list(self.langs), pa.string()).take(pa.array(of & 0xFFFFFF)),
            pa.array(list(self.terms), pa.binary()).cast(pa.string()).take(pa.array(of >> 24)),
            self.documents[1], sources, n, first,
        )
        self.__init__()
        return row


def _firsts(sorted_: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(sorted_) else np.zeros(0, np.int64)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its numbers."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = _firsts(keys)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _rows(lang: pa.Array, term: pa.Array, documents: np.ndarray, sources: pa.Array, n: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    """Rows whose lists begin at ``first``."""
    ends = pa.array(np.append(first, len(n)).astype(np.int32))
    columns = [lang, term, pa.array(documents, pa.int64()), pa.ListArray.from_arrays(ends, sources), pa.ListArray.from_arrays(ends, pa.array(n, pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "term", "documents", "sources", "counts"])


def _merged(rows: pa.Table) -> pa.RecordBatch:
    """Rows of equal (lang, term), which stand together, as one."""
    n = rows.num_rows
    lang, term, documents, sources, counts = (rows.column(c).combine_chunks() for c in ("lang", "term", "documents", "sources", "counts"))
    new = np.ones(n, bool)
    if n > 1:
        other = [pc.not_equal(c.slice(1), c.slice(0, n - 1)) for c in (lang, term)]
        new[1:] = np.asarray(pc.or_(*other))
    number = np.cumsum(new) - 1
    row = np.repeat(number, np.asarray(pc.list_value_length(sources)))
    encoded = pc.dictionary_encode(pc.list_flatten(sources))
    key, summed = _summed(row << 32 | np.asarray(encoded.indices).astype(np.int64), np.asarray(pc.list_flatten(counts)))
    at = pa.array(np.flatnonzero(new))
    total = np.add.reduceat(np.asarray(documents), np.flatnonzero(new))
    return _rows(lang.take(at), term.take(at), total, encoded.dictionary.take(pa.array(key & 0xFFFFFFFF)), summed, _firsts(key >> 32))


def stripes(docs: DataFrame, least: int = 1, cells: int = CELLS) -> DataFrame:
    """Merged stripes of ``docs`` (lang, source, text, none null): one row per language and term of at least ``least``
    documents."""

    def fold(parts):
        found = Stripes()
        for batch in parts:
            for part in batches.slices(batch, "text"):
                texts, langs, sources = batches.column_bytes(part.column("text")), part.column("lang").to_pylist(), part.column("source").to_pylist()
                found.fold(texts, langs, sources)
                if found.size() > cells or len(found.groups) > cells:
                    yield from _parts(found.spill())
        yield from _parts(found.spill())

    def merge(parts):
        held = None
        for batch in parts:
            if not batch.num_rows:
                continue
            rows = _merged(pa.Table.from_batches([*([held] if held is not None else []), batch]))
            held = rows.slice(rows.num_rows - 1)  # the last term may go on
            yield kept(rows.slice(0, rows.num_rows - 1))
        if held is not None:
            yield kept(held)

    def kept(rows: pa.RecordBatch) -> pa.RecordBatch:
        return rows.filter(pc.greater_equal(rows.column("documents"), least))

    spilled = docs.select("lang", "source", "text").mapInArrow(fold, _STRIPES)
    return spilled.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(merge, _STRIPES)


def _parts(rows: pa.RecordBatch, most: int = 1 << 14):
    for begin in range(0, rows.num_rows, most):
        yield rows.slice(begin, most)


def share(count: Column, total: Column, terms: Column) -> Column:
    """p, in decimals that hold any count."""
    top = (count + F.lit(PRIOR)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    bottom = (total + terms * F.lit(PRIOR)).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", top, bottom)


def shares(counts: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    """p of an array of counts; 1e9 = 31250 * 32000 keeps products within 64 bits."""
    first, rest = np.divmod((counts + PRIOR) * 31_250, bottom)
    return 1 + first * 32_000 + rest * 32_000 // bottom


def divergences(docs: DataFrame, *, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Rows (lang, source, part, item, value, rank): see the query's contract in :mod:`op12`."""
    named = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    given = docs.select(named(lang, "lang"), named(source, "source"), named(text, "text"))
    kept = materialize(stripes(given, MIN_DOCUMENTS), "divergence-stripes")
    totals = materialize(_totals(given, kept), "divergence-totals")
    return _pairs(kept, totals).unionByName(_terms(kept, totals))


def _totals(given: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows (lang, source, number, total, lang_total, terms) for each occurring source of a language: its number among
    them, the counts of its kept terms and of the language's, and how many terms are kept."""
    counted = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c"))
    counted = counted.groupBy("lang", F.col("c.sources").alias("source")).agg(F.sum("c.counts").alias("total"))
    langs = kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)).alias("lang_total")
    )
    zero = F.lit(0).cast("long")
    return (
        given.groupBy("lang", "source").agg(F.lit(1))
        .join(counted, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang",
            "source",
            (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("number"),
            *(F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "terms")),
        )
    )


def _pairs(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """All pairs of sources of a language, both ways, with their ranks."""
    spark = kept.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unit = ["lang", "low", "high", "part"]

    blocks = totals.groupBy("lang").agg((F.floor(F.max("number") / BLOCK)).cast("int").alias("last"))
    both = F.expr("flatten(transform(sequence(0, last), i -> transform(sequence(i, last), j -> struct(i AS low, j AS high))))")
    squares = blocks.select("lang", F.explode(both).alias("s")).select("lang", "s.low", "s.high")

    mine = totals.join(squares, "lang").filter(F.floor(F.col("number") / BLOCK).isin(F.col("low"), F.col("high")))
    heads = mine.select(
        "lang", "low", "high", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        F.lit(0).alias("kind"), "source", "number", (F.col("total") + PRIOR * F.col("terms")).alias("bottom"),
    )
    # Stripes go to the squares in which one of their sources occurs; with one block, to that.
    many = blocks.filter("last > 0").select("lang")
    numbered = kept.join(broadcast_if_small(many), "lang", "left_semi").select("lang", "term", F.explode("sources").alias("source"))
    touched = numbered.join(broadcast_if_small(totals.select("lang", "source", "number")), ["lang", "source"])
    touched = touched.select("lang", "term", F.floor(F.col("number") / BLOCK).cast("int").alias("block")).distinct()
    touched = touched.join(squares, "lang").filter(F.col("block").isin(F.col("low"), F.col("high")))
    touched = touched.select("lang", "term", "low", "high").distinct()
    single = kept.join(broadcast_if_small(many), "lang", "left_anti").withColumns({"low": F.lit(0), "high": F.lit(0)})
    sent = single.unionByName(kept.join(touched, ["lang", "term"]))
    sent = sent.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int")).withColumn("kind", F.lit(1))

    columns = [*unit, "kind", "source", "number", "bottom", "sources", "counts"]
    stream = heads.unionByName(sent.select(*unit, "kind", "sources", "counts"), allowMissingColumns=True).select(columns)
    schema = "lang string, a string, b string, value long"
    partial = stream.repartition(*unit).sortWithinPartitions(*unit, "kind", "number").mapInArrow(_square_sums, schema)
    # What no stripe changes: each kept term adds the difference of two sources in which it does not occur.
    names = totals.select("lang", "source", "terms", (F.col("total") + PRIOR * F.col("terms")).alias("bottom"))
    a, b = names.alias("a"), names.alias("b")
    floor = a.join(b, F.col("a.lang") == F.col("b.lang")).filter(F.col("a.source") < F.col("b.source"))
    zero = F.lit(0).cast("long")
    bare = lambda side: F.when(F.col(f"{side}.terms") > 0, share(zero, F.col(f"{side}.bottom"), zero))
    floor = floor.select(
        F.col("a.lang").alias("lang"), F.col("a.source").alias("a"), F.col("b.source").alias("b"),
        F.coalesce(F.abs(bare("a") - bare("b")) * F.col("a.terms"), zero).alias("value"),
    )
    summed = floor.unionByName(partial).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return _ranked(summed.select("lang", ways.alias("w"), "value").select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value"))


def _square_sums(parts):
    """For each two sources of a unit, what its stripes add beyond the difference of two zero counts."""
    unit, heads, sums = None, [], None

    def begin():
        nonlocal sums
        names, numbers, bottom = zip(*heads)
        bottom = np.array(bottom, dtype=np.int64)
        none = shares(np.zeros(len(bottom), np.int64), np.maximum(bottom, 1))
        sums = {"of": {n: i for i, n in enumerate(names)}, "names": names, "bottom": bottom, "none": none, "all": np.zeros((len(names), len(names)), np.int64)}
        sums["block"] = np.array(numbers) // BLOCK

    def add(sources: list[list[str]], counts: list[list[int]]) -> None:
        n = len(sums["names"])
        step = max(1, (1 << 20) // n)
        for at in range(0, len(sources), step):
            held = np.zeros((len(sources[at : at + step]), n), np.int64)
            for row, (mine, many) in enumerate(zip(sources[at : at + step], counts[at : at + step])):
                for source, count in zip(mine, many):
                    i = sums["of"].get(source)
                    if i is not None:
                        held[row, i] = count
            p = shares(held, sums["bottom"])
            for i in range(n - 1):
                base = np.abs(sums["none"][i + 1 :] - sums["none"][i])
                sums["all"][i, i + 1 :] += np.abs(p[:, i + 1 :] - p[:, i : i + 1]).sum(axis=0) - base * len(held)

    def end() -> pa.RecordBatch:
        lang, low, high, _ = unit
        a, b = np.nonzero(sums["all"])
        if low != high:  # pairs within a block belong to its own square
            across = sums["block"][a] != sums["block"][b]
            a, b = a[across], b[across]
        names = sums["names"]
        pick = lambda at: pa.array([names[i] for i in at.tolist()], pa.string())
        columns = [pa.array([lang] * len(a), pa.string()), pick(a), pick(b), pa.array(sums["all"][a, b])]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "value"])

    for batch in parts:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "low", "high", "part"))))
        kinds, columns = batch.column("kind").to_pylist(), {c: batch.column(c).to_pylist() for c in ("source", "number", "bottom", "sources", "counts")}
        at = 0
        while at < len(keys):
            if keys[at] != unit:
                if sums:
                    yield end()
                unit, heads, sums = keys[at], [], None
            stop = at
            while stop < len(keys) and keys[stop] == unit and kinds[stop] == kinds[at]:
                stop += 1
            if kinds[at] == 0:
                heads += zip(*(columns[c][at:stop] for c in ("source", "number", "bottom")))
            else:
                if sums is None:
                    begin()
                add(columns["sources"][at:stop], columns["counts"][at:stop])
            at = stop
    if sums:
        yield end()


def _terms(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """For each source of a language the terms that it has more of than the language, the first ranks."""
    whole = F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b).alias("whole")
    found = kept.select("lang", "term", whole, F.explode(F.arrays_zip("sources", "counts")).alias("c"))
    found = found.select("lang", "term", "whole", F.col("c.sources").alias("source"), F.col("c.counts").alias("count"))
    found = found.join(broadcast_if_small(totals.drop("number")), ["lang", "source"])
    p, q = share(F.col("count"), F.col("total"), F.col("terms")), share(F.col("whole"), F.col("lang_total"), F.col("terms"))
    found = found.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).cast("long").alias("value"))
    return _ranked(found.filter("value > 0")).filter(F.col("rank") <= TOP_TERMS)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order).cast("int"))
