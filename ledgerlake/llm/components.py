"""Connected components of a link table, by alternating star steps.

Every round, each node is linked to the smallest node it knows; stars of
larger and of smaller neighbours take turns, so the number of rounds grows
with the logarithm of a component's size. Tables stay on Spark: the driver
sees one count per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import staged


def _with_smallest(edges: DataFrame) -> DataFrame:
    """edges (u, v) with m, the smallest of u and its neighbours."""
    smallest = staged(edges.groupBy("u").agg(F.min("v").alias("m"))
                      .select("u", F.least("u", "m").alias("m")), "components-min")
    return edges.join(smallest, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_smallest(down)
    return (linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(linked.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v longs): the
    smallest node that can be reached. Loops and repeated links do no harm;
    an empty table gives no rows."""
    edges = staged(links.where("u <> v").select("u", "v").distinct(), "components")
    before = None
    while True:
        stars = staged(_small_star(staged(_large_star(edges), "components")), "components")
        # Finished when a round changes nothing: same number of edges and
        # same sums.
        now = tuple(stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before or now[0] == 0:
            break
        before, edges = now, stars
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return staged(nodes.unionByName(roots).distinct(), "components")
