"""Count sketch (Charikar, Chen, Farach-Colton 2002): signed counters, estimate = median over rows.

A row adds its sign to one cell of each sketch row; every task adds up its own depth x width cells before anything is shuffled. Cells
of several sketches add up to the sketch of all their rows, and the cells of a stream are its state.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRIME = 2147483647

# Per sketch row the factors and offsets of the bucket hash and of the sign hash.
HASHES = (
    (1103515245, 12345, 1664525, 1013904223),
    (69069, 907633385, 22695477, 97531),
    (134775813, 524287, 214013, 2531011),
    (1140671485, 12820163, 16807, 65539),
    (48271, 362436069, 39373, 521288629),
)


def item_hash(c) -> Column:
    """28-bit number of an item's text, from its MD5 digest."""
    return F.conv(F.substring(F.md5(F.col(c).cast("string")), 1, 7), 16, 10).cast("long")


def _cells(df: DataFrame, item: str, depth: int, width: int) -> DataFrame:
    """One row per item and sketch row, with the bucket and the sign of the item."""
    h = F.col("_h")
    rows = [
        F.struct(
            F.lit(i).alias("row"),
            ((h * a + b) % PRIME % width).cast("int").alias("bucket"),
            ((h * c + d) % PRIME % 2 * 2 - 1).cast("int").alias("sign"),
        )
        for i, (a, b, c, d) in enumerate(HASHES[:depth])
    ]
    return df.withColumn("_h", item_hash(item)).select("*", F.inline(F.array(*rows))).drop("_h")


def count_sketch(df: DataFrame, item: str, depth: int = 5, width: int = 64) -> DataFrame:
    """The sketch as a table (row, bucket, total), at most depth x width rows; of a table or of a stream.

    At most depth x width rows of a task are shuffled, however many items there are. A null item is none.
    """
    cells = _cells(df.select(item).filter(F.col(item).isNotNull()), item, depth, width)
    return cells.groupBy("row", "bucket").agg(F.sum("sign").alias("total"))


def add(*sketches: DataFrame) -> DataFrame:
    """The sketch of all rows of several sketches of the same depth and width, such as those of days."""
    cells = reduce(lambda a, b: a.unionByName(b), [s.select("row", "bucket", "total") for s in sketches])
    return cells.groupBy("row", "bucket").agg(F.sum("total").alias("total"))


def estimate(sketch: DataFrame, items: DataFrame, item: str, depth: int = 5, width: int = 64) -> DataFrame:
    """Estimated count of each distinct item."""
    asked = _cells(items.select(item).distinct(), item, depth, width)
    found = asked.join(F.broadcast(sketch), ["row", "bucket"], "left")
    votes = F.coalesce(F.col("sign") * F.col("total"), F.lit(0))
    return found.groupBy(item).agg(F.percentile(votes, F.lit(0.5)).alias("estimate"))
