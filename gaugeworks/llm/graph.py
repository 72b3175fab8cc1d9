"""Connected components of a link table, in rounds over Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; ``root`` is the
    smallest node of its component.

    Alternates two contractions until nothing changes: every node joins its
    larger neighbours to its smallest one (large star), then its smaller
    neighbours and itself (small star).  Edges never grow in number, and the
    rounds grow with the logarithm of the path lengths.  Only counts and sums reach
    the driver.  ``rows`` bounds the number of links, where it is known."""
    edges = written(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links", rows
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        after = written(small.where("a != b").distinct(), "links", rows if before is None else before[0])
        state = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop_written(edges)
        edges = after
        if state == before:
            break
        before = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
