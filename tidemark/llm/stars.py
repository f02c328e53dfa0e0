"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _with_least(edges: DataFrame, of: DataFrame) -> DataFrame:
    """``edges`` (u, v) with the least neighbour ``m`` of u among ``of``. The second condition follows from the first;
    it makes Spark shuffle both sides for the join itself, so that adaptive execution can split a hot node."""
    least = of.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "w")
    return edges.join(least, (F.col("u") == F.col("w")) & (F.xxhash64("u") == F.xxhash64("w"))).drop("w")


def _large(edges: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to the least of its neighbours and itself."""
    up = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    found = _with_least(up, edges.unionByName(up))
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every node sends its smaller neighbours and itself to the least of them."""
    found = _with_least(edges, edges)
    sent = found.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return sent.filter("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for every node of the edges but the roots; a root is the least node of its component.

    Nodes are numbers. Each half round starts from written rows, so a lost executor costs a read; rounds end when
    one of them changes nothing. No edges give no rows; edges of a node with itself are left out.
    """
    stars = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    stars = materialize(stars, "stars")
    before = None
    while True:
        state = tuple(stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        stars = materialize(_small(materialize(_large(stars), "large-stars")), "small-stars")
