"""Document fingerprints by consistent weighted sampling.

A text is a set of words weighted by their counts. For each of ``samples`` draws every word has a step
r and a height c, both Gamma(2, 1), and an offset beta, uniform, all of them functions of the word and
the number of the draw (Gamma values come from a table of quantiles, for speed). The count w is rounded down on the word's grid, t = floor(ln w / r + beta), and
the word with the least ln c - r (t - beta + 1) is drawn. Two texts draw the same word at the same
level t with a probability equal to their generalised Jaccard similarity (sum of the lesser by sum of the
greater counts), so the share of equal draws estimates it; its standard error is at most
0.5 / sqrt(samples). A level and a word determine the least value, so 16 bits of a hash of that value
stand for the draw.

``neighbours`` puts each row beside its next one in descending order of the id without a global
window: rows are dealt by ranges of the id and a hash of the text, and the first row of each range also goes, as
a guest, to the end of the range before it. A range that outgrows memory, beyond ``MOST_RANGES`` of them, is
sorted on disk.

Defined results: a null text is empty; a text without words draws nothing, and all such texts have one
fingerprint, unlike any other; ids are of any type that has an order; null ids come last, rows with one id by a
hash of the text; a single row is its own neighbour; equal rows are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.numbering import _bounds, _with_range
from ..session import materialize

SAMPLES = 64
AT_ONCE = 8
ROWS_PER_RANGE = 1000
MOST_RANGES = 2**14


def _gamma_quantile(p: float) -> float:
    """Where the distribution function of Gamma(2, 1), 1 - (1 + x) exp(-x), is ``p``."""
    low, high = 0.0, 64.0
    for _ in range(64):
        middle = (low + high) / 2
        low, high = (middle, high) if 1 - (1 + middle) * math.exp(-middle) < p else (low, middle)
    return high


#: Probabilities at the centres of 256 equal cells, from entry 256 on; the first cell, the tail that decides
#: a draw among many words, is cut into 256 finer ones, entries 0 to 255.
_CELLS = [(i + 0.5) / 65536 for i in range(256)] + [(i + 0.5) / 256 for i in range(256)]


def words(text: Column) -> Column:
    """The words of a text, in lower case, and maybe an empty one, which :func:`term` makes null; a
    text without words has that one only."""
    return F.split(F.lower(text), r"[\x20\x09-\x0D]+")


def term(word: Column) -> Column:
    return F.when(word != "", F.xxhash64(word))


def draws(counts: DataFrame, keys: Sequence[str], samples: int = SAMPLES) -> DataFrame:
    """Rows (keys, part, drawn): ``drawn`` has the least value of each draw of a part, ``AT_ONCE`` of them.

    ``counts`` has a row per key and ``term`` with its count ``n``. A null term is never drawn; a key
    that has no other gets nulls. Draws are rows as far as that keeps the plan small, and columns
    as far as that saves rows.
    """
    if samples % AT_ONCE:
        raise ValueError(f"the number of samples must be a multiple of {AT_ONCE}")
    # Not constant to the optimiser, which would copy the tables into each draw.
    table = lambda values: F.when(F.col("n").isNotNull(), F.array(*map(F.lit, values)))
    tables = counts.select(
        *keys,
        "term",
        F.when(F.col("term").isNotNull(), F.log("n")).alias("log_n"),
        table([_gamma_quantile(1 - p) for p in _CELLS]).alias("steps"),
        table([math.log(_gamma_quantile(p)) for p in _CELLS]).alias("heights"),
        F.explode(F.sequence(F.lit(0), F.lit(samples // AT_ONCE - 1))).alias("part"),
    )

    def least(k: int) -> Column:
        bits = F.xxhash64("term", F.col("part") * AT_ONCE + k)
        part = lambda at, n: F.shiftright(bits, at).bitwiseAND((1 << n) - 1)
        cell = lambda at: F.when(part(at, 8) > 0, part(at, 8) + 256).otherwise(part(at + 8, 8)).cast("int")
        step, height = F.get("steps", cell(0)), F.get("heights", cell(16))
        offset = (part(32, 16) + 0.5) / 65536.0
        level = F.floor(F.col("log_n") / step + offset)
        # Null where the term is: a condition around it would keep the hash and the step from being shared.
        return F.min(height - step * (level - offset + 1)).alias(f"draw_{k}")

    least_values = tables.groupBy(*keys, "part").agg(*(least(k) for k in range(AT_ONCE)))
    return least_values.select(*keys, "part", F.array(*(f"draw_{k}" for k in range(AT_ONCE))).alias("drawn"))


def joined(parts: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per key: the arrays ``names`` of its parts, one after another."""
    ordered = F.array_sort(F.collect_list(F.struct("part", *names)))
    whole = parts.groupBy(*keys).agg(ordered.alias("parts"))
    return whole.select(*keys, *(F.flatten(F.col(f"parts.{n}")).alias(n) for n in names))


def signature(drawn: Column) -> Column:
    """A 16-bit number for each least value, -1 where there is none."""
    return F.transform(
        drawn, lambda x: F.when(x.isNull(), -1).otherwise(F.xxhash64(x).bitwiseAND(0xFFFF)).cast("int")
    )


def as_text(signature: Column) -> Column:
    """Four hexadecimal digits per draw; dashes where there was nothing to draw from."""
    digits = F.transform(signature, lambda x: F.when(x < 0, "----").otherwise(F.lower(F.lpad(F.hex(x), 4, "0"))))
    return F.array_join(digits, "")


def likeness(one: Column, other: Column) -> Column:
    """The share of equal draws."""
    same = F.filter(F.zip_with(one, other, lambda a, b: a == b), lambda x: x)
    return F.size(same) / F.size(one)


def neighbours(docs: DataFrame, ident: str, text: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Rows (range, place, guest, id, text, next): each text with the next one, dealt by range.

    ``place`` numbers the rows of a range; guests come last and are there for the row before them. Ranges are
    cut by id and hash of the text, so rows that share an id are spread too; if copies of one row would
    fill more than a range, the rows are first written with the order in which they were read.
    """
    order = ["known", "id", "tie"]
    rows = docs.select(
        F.col(ident).isNotNull().alias("known"),
        F.col(ident).alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tie"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    keys = materialize(rows.select(*order), "fingerprint-keys")
    bounds = _bounds(keys, order, rows_per_range, MOST_RANGES)
    if any(low == high for low, high in zip(bounds, bounds[1:])):
        rows = materialize(rows.withColumn("read", F.monotonically_increasing_id()), "fingerprint-rows")
        order.append("read")
        keys = rows.select(*order)
        bounds = _bounds(keys, order, rows_per_range, MOST_RANGES)
    key = F.struct(*order)
    firsts = _with_range(keys, order, bounds, "range").groupBy("range").agg(F.max(key).alias("first"))
    every = Window.orderBy("range")  # at most MOST_RANGES rows; the last range's first row is hosted by range 0
    host = F.coalesce(F.lead("range").over(every), F.first("range").over(every))
    hosts = materialize(firsts.select("range", "first", host.alias("host")), "fingerprint-hosts")
    seat = lambda of, guest: F.struct(F.col(of).alias("range"), F.lit(guest).alias("guest"))
    seats = F.when(key.eqNullSafe(F.col("first")), F.array(seat("range", 0), seat("host", 1))).otherwise(
        F.array(seat("range", 0))
    )
    seated = (
        _with_range(rows, order, bounds, "range")
        .join(F.broadcast(hosts), "range")
        .select(*order, "text", F.inline(seats))
    )
    in_order = Window.partitionBy("range").orderBy("guest", *(F.col(c).desc_nulls_last() for c in order), "text")
    return seated.select(
        "range",
        F.row_number().over(in_order).alias("place"),
        "guest",
        "id",
        "text",
        F.lead("text").over(in_order).alias("next"),
    )


def edited(text: Column, next_text: Column) -> Column:
    """The last half of the characters, rounded down, replaced by the first as many of the next text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(next_text, F.lit(1), half))


def fingerprints(docs: DataFrame, *, ident: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Id and fingerprint of every row; the key of the grouping is a hash of id and text, so equal
    rows, which have equal fingerprints, are given back together with their number ``rows``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    counts = (
        docs.select(F.col(ident).alias("id"), F.xxhash64(whole).alias("content"), F.explode(words(whole)).alias("word"))
        .groupBy("id", "content", term(F.col("word")).alias("term"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    drawn = draws(counts, ["id", "content"], samples)
    signed = drawn.select("id", "content", "part", signature(F.col("drawn")).alias("signature"))
    return joined(signed, ["id", "content"], ["signature"]).withColumn("fingerprint", as_text(F.col("signature")))


def compare_with_edits(
    docs: DataFrame,
    *,
    ident: str = "doc_id",
    text: str = "text",
    samples: int = SAMPLES,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness to it and to the next text.

    The texts are shuffled once, to their ranges; words are counted and drawn where they are. A word
    with one count in both texts is drawn for both at once.
    """
    beside = neighbours(docs, ident, text, rows_per_range)
    half = edited(F.col("text"), F.coalesce("next", F.lit("")))
    texts = F.when(F.col("guest") == 1, F.array("text")).otherwise(F.array("text", half))
    rows = ["range", "place"]
    counts = (
        beside.select(*rows, F.posexplode(texts).alias("variant", "body"))
        .select(*rows, "variant", F.explode(words(F.col("body"))).alias("word"))
        .groupBy(*rows, term(F.col("word")).alias("term"))
        .agg(F.count_if(F.col("variant") == 0).alias("own"), F.count_if(F.col("variant") == 1).alias("changed"))
    )
    use = lambda of, n: F.struct(F.lit(of).alias("of"), F.col(n).alias("n"))
    uses = F.when(F.col("own") == F.col("changed"), F.array(use("both", "own"))).otherwise(
        F.array(use("own", "own"), use("changed", "changed"))
    )
    apart = counts.select(*rows, "term", F.inline(uses)).filter("n > 0")
    drawn = draws(apart, [*rows, "of"], samples)
    of = lambda name: F.max(F.when(F.col("of") == name, F.col("drawn")))
    lesser = lambda a, b: F.zip_with(F.coalesce(a, b), F.coalesce(b, a), lambda x, y: F.least(x, y))
    signed = (
        drawn.groupBy(*rows, "part")
        .agg(of("own").alias("own"), of("changed").alias("changed"), of("both").alias("both"))
        .select(
            *rows,
            "part",
            signature(lesser(F.col("own"), F.col("both"))).alias("own"),
            signature(lesser(F.col("changed"), F.col("both"))).alias("changed"),
        )
    )
    signatures = joined(signed, rows, ["own", "changed"])
    about = beside.select(
        *rows,
        "guest",
        "id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(half.cast("binary"), 256).alias("edited_sha256"),
    )
    in_order = Window.partitionBy("range").orderBy("place")
    return (
        about.join(signatures, rows)
        .withColumn("following", F.lead("own").over(in_order))
        .filter("guest = 0")
        .select(
            "id",
            "n_chars",
            "edited_sha256",
            as_text(F.col("own")).alias("fingerprint"),
            as_text(F.col("changed")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("following")).alias("near_next"),
        )
    )
