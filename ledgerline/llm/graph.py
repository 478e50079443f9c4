"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a group-by and a join; nothing is gathered on the driver but two numbers for the convergence test, which is
exact: the search ends when every node has one link and none to a node that has one itself, that is, when all
components are stars around their smallest node.  A hub's links are dealt over several tasks in the join.  The tables
of earlier steps are deleted as soon as a step is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, cut, drop

#: Links of one node that meet its smallest neighbour in one task.
HUB = 1 << 16


def _with_least(links: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """``links`` (u, v) with m, the least node of u from ``least`` (u, m, c).  Where ``n`` links can make a hub, hubs, of
    which there are at most n / HUB, are dealt over tasks."""
    if n <= HUB:
        return links.join(least.drop("c"), "u")
    hubs = bounded_broadcast(least.where(F.col("c") > HUB).select("u", F.ceil(F.col("c") / HUB).cast("int").alias("k")), row_bytes=32)
    dealt = links.join(hubs, "u", "left").withColumn("part", F.pmod(F.xxhash64("v"), F.coalesce("k", F.lit(1))).cast("int")).drop("k")
    each = least.withColumn("part", F.explode(F.sequence(F.lit(0), F.ceil(F.col("c") / HUB).cast("int") - 1))).drop("c")
    return dealt.join(each, ["u", "part"]).drop("part")


def _large_star(e: DataFrame, n: int) -> DataFrame:
    both = e.union(e.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("c"))
    return _with_least(both, least, 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame, n: int) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c"))
    moved = _with_least(down, least, 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u long, v long); root is the component's smallest node.  Repeated links and
    links of a node to itself count for nothing; without links there is no row."""
    e = cut(links.select("u", "v").where("u <> v").distinct(), "links")
    while True:
        n, nodes, up = e.agg(F.count("*"), F.count_distinct("u"), F.count_if(F.col("u") < F.col("v"))).first()
        # All are stars: each node but the centres has one link, to a smaller node, and no centre has one.
        if n == nodes and not up and e.select(F.col("v").alias("u")).join(e.select("u"), "u", "left_semi").isEmpty():
            return e.groupBy("u").agg(F.min("v").alias("root")).union(e.select("v", "v").distinct()).toDF("node", "root")
        new = cut(_small_star(_large_star(e, n), n).distinct(), "links")
        drop(e)
        e = new
