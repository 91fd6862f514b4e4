"""Connected components of a table of links, on the cluster.

Alternating large-star and small-star rounds (Kiveris et al., 2014): every
half round is one aggregate, combined before its shuffle, and one join of the
links to it. Both are written to the shared folder, so lineage stays short and
the links of a node that a third of them have are joined to a plain table of
one row a node, which Spark splits. Only a count and a checksum of the links
reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import saved


def _star(sides: DataFrame) -> DataFrame:
    """Each node's least neighbour or itself: (u, m)."""
    return sides.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))


def _large(links: DataFrame) -> DataFrame:
    """Larger neighbours move to the least one."""
    sides = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    return sides.where("v > u").join(saved(_star(sides), "least"), "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them."""
    sides = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = saved(sides.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = sides.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component is the least node reachable.

    Null ends, loops and repeated links count for nothing. No links: no rows.
    """
    now = saved(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or mark == before:
            break
        before = mark
        now = saved(_small(_large(now)), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .union(now.select(F.col("b"), F.col("b")).distinct())
