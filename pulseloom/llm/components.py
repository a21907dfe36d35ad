"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of `links` (a, b): label is the smallest node of its component.

    Large-star, small-star: every node hangs its larger neighbours, then its smaller ones, on its smallest
    neighbour. The paths shrink by a constant factor a round, so rounds grow with the logarithm of their length. Every
    round is written to the shared folder, which cuts the lineage; only a count and a hash of the links come to the driver.
    """
    now = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    state = summary(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = star(both).filter("b > a")
        hung = large.select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        down = hung.select(F.col("b").alias("a"), F.col("a").alias("b"))
        small = star(down, own=False)
        now = materialize(
            small.select(F.col("m").alias("a"), "b").unionByName(small.select(F.col("m").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "links"
        )
        before, state = state, summary(now)
        if state == before:
            break
    smallest = now.groupBy("b").agg(F.min("a").alias("label")).select(F.col("b").alias("node"), "label")
    return smallest.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())


def star(pairs: DataFrame, own: bool = True) -> DataFrame:
    """(a, b, m): m is the smallest of a's neighbours (and a itself)."""
    least = pairs.groupBy("a").agg(F.min("b").alias("least"))
    m = F.least("a", "least") if own else F.col("least")
    return pairs.join(least.select("a", m.alias("m")), "a")


def summary(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
