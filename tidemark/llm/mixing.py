"""Mix sources to target weights with hash-threshold histograms.

Every row has a hash that depends on its content only. Sizes are summed by source and hash bucket;
in each source the buckets below its budget are taken, and only the bucket on the boundary is cut
into finer buckets, until one hash value is left there. Budgets are nested: the rows taken for a
small budget are taken for every larger one. Nothing is sorted, and the rows are filtered by one
comparison with the threshold of their source.

Defined results: a null text has size 0; a null source is a source, the last one; an empty source,
or one of empty texts, has the target 0; rows with one id (or without id, with one text) have one
hash and are taken together; an empty table gives an empty result; columns of the input keep their
names and values, ``copies`` is replaced if it is there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from ..session import materialize
from .text import private, word_count

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
HASH_BITS = 60  # hexadecimal digits times four
BUCKET_BITS = 10


def row_hash(ident: Column, text: Column) -> Column:
    """60 bits of md5 of the id as text, or of the text where the id is null."""
    named = F.coalesce(ident.cast("string"), F.concat(F.lit("null:"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, *, ident: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The narrow table behind all decisions: id, source, words and hash of each row."""
    return docs.select(
        F.col(ident).alias("ident"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        row_hash(F.col(ident), F.col(text)).alias("hash"),
    )


def targets(narrow: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: size, weight and target.

    The sources, by code point with null last, take the weights in turn and share all words. What
    a target exceeds ``most`` times its source by is shared again by weight. The level (words per
    unit of weight) only rises from round to round, so a source that is full stays full, and the
    rounds end when no further source is full. One row per source is all that is ranked.
    """
    per_source = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.array(*map(F.lit, weights))
    ranked = materialize(
        per_source.withColumn("weight", F.element_at(turn, (rank % len(weights) + 1).cast("int")).cast("long")),
        "mix-sources",
    )
    full = most * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        reached = full <= F.lit(level) * F.col("weight")
        capped, free = ranked.agg(
            F.sum(F.when(reached, full).otherwise(0)), F.sum(F.when(reached, 0).otherwise(F.col("weight")))
        ).first()
        higher = (total - capped) / free if free else level
        if higher <= level:
            break
        level = higher
    return ranked.withColumn("target", F.least(F.lit(level) * F.col("weight"), full.cast("double")))


def thresholds(narrow: DataFrame, shares: DataFrame, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """One row per source: how often every row is taken (``whole``), and below which hash once more.

    ``shares`` is the result of :func:`targets`. Each round reads the rows of the boundary buckets
    only. It ends when each boundary bucket holds a single hash value, which is taken if that is
    nearer to the target.
    """
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long")
    bounds = materialize(
        shares.withColumn("whole", whole)
        .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("low", F.lit(0).cast("long"))
        .withColumn("open", F.col("budget") > 0),
        "mix-bounds",
    )
    width = HASH_BITS
    while width and not bounds.filter("open").isEmpty():
        step = min(bucket_bits, width)
        rest = width - step
        before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        here = broadcast_if_small(bounds.filter("open").select(F.col("source").alias("of"), "low", "budget"))
        inside = narrow.join(here, F.col("source").eqNullSafe(F.col("of"))).filter(
            F.shiftright("hash", width) == F.shiftright("low", width)
        )
        boundary = (
            inside.groupBy("source", F.shiftright("hash", rest).alias("bucket"))
            .agg(
                F.sum("size").alias("words"),
                F.min("hash").alias("least"),
                F.max("hash").alias("most"),
                F.max("budget").alias("had"),
            )
            .withColumn("below", F.coalesce(F.sum("words").over(before), F.lit(0)))
            .filter((F.col("below") <= F.col("had")) & (F.col("below") + F.col("words") > F.col("had")))
            .withColumn("left", F.col("had") - F.col("below"))
            .withColumn("single", F.col("least") == F.col("most"))
            .withColumn("take", F.col("single") & (F.col("left") * 2 >= F.col("words")))
        )
        found = boundary.select(
            F.col("source").alias("of"), "bucket", "left", "single", "take", F.col("most").alias("last")
        )
        bounds = materialize(
            bounds.join(broadcast_if_small(found), F.col("source").eqNullSafe(F.col("of")), "left").select(
                "source",
                "source_size",
                "weight",
                "target",
                "whole",
                F.coalesce("left", "budget").alias("budget"),
                F.when(F.col("take"), F.col("last") + 1)
                .when(F.col("single"), F.col("last"))
                .when(F.col("bucket").isNotNull(), F.shiftleft("bucket", rest))
                .otherwise(F.col("low"))
                .alias("low"),
                F.coalesce(~F.col("single"), F.lit(False)).alias("open"),
            ),
            "mix-bounds",
        )
        width = rest
    return bounds.select("source", "source_size", "target", "whole", F.col("low").alias("threshold"))


def copies_of(hash_: Column) -> Column:
    """How often a row is taken, beside the columns of :func:`thresholds`."""
    return F.col("whole") + F.when(hash_ < F.col("threshold"), 1).otherwise(0)


def mix(
    docs: DataFrame,
    *,
    ident: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
) -> DataFrame:
    """``docs`` with a column ``copies``: how often the mix takes the row, 0 to ``most`` times."""
    narrow = materialize(sized(docs, ident=ident, text=text, source=source), "mix-sizes")
    limits = thresholds(narrow, targets(narrow, weights, most))
    plain = docs.drop("copies")
    of, whole, threshold = (private(plain, f"mix_{c}") for c in ("source", "whole", "threshold"))
    limits = limits.select(
        F.col("source").alias(of), F.col("whole").alias(whole), F.col("threshold").alias(threshold)
    )
    once_more = row_hash(F.col(ident), F.col(text)) < F.col(threshold)
    return (
        plain.join(broadcast_if_small(limits), F.col(source).eqNullSafe(F.col(of)))
        .withColumn("copies", F.col(whole) + F.when(once_more, 1).otherwise(0))
        .drop(of, whole, threshold)
    )
