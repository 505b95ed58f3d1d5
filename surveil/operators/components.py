"""Connected components of many independent graphs at once.

Each graph (here: the cells of one time window) is named by ``group``. Nodes are bigint ids. All
graphs go through the same rounds of star contraction (large-star / small-star, Kiveris et al.,
SoCC 2014); every step is a grouped minimum and a join, and every round is staged.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.session import stage


def connected_components(edges: DataFrame, group: str) -> DataFrame:
    """(group, node, component) for every node of ``edges(group, a, b)``.

    ``component`` is the smallest node id of its component. ``edges`` should be staged: it
    is read more than once.
    """
    nodes = edges.select(group, F.explode(F.array("a", "b")).alias("node")).distinct()
    links = _oriented(edges, group)
    before = None
    while True:
        links = stage(_small_star(_large_star(links, group), group), "links")
        state = tuple(links.agg(F.count("*"), F.sum(F.xxhash64(group, "u", "v").cast("decimal(20,0)"))).first())
        if state == before:
            break
        before = state
    return nodes.join(links.withColumnRenamed("u", "node"), [group, "node"], "left").select(
        group, "node", F.coalesce("v", "node").alias("component"))


def _oriented(edges: DataFrame, group: str) -> DataFrame:
    """Edges as (u, v) with u > v, without repeats and loops."""
    return edges.filter("a <> b").select(
        group, F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def _large_star(links: DataFrame, group: str) -> DataFrame:
    both = links.unionByName(links.select(group, F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy(group, "u").agg(F.least(F.min("v"), F.col("u")).alias("_low"))
    moved = both.filter("v > u").join(lowest, [group, "u"])
    return moved.select(group, F.col("v").alias("u"), F.col("_low").alias("v")).distinct()


def _small_star(links: DataFrame, group: str) -> DataFrame:
    lowest = links.groupBy(group, "u").agg(F.min("v").alias("_low"))
    moved = links.join(lowest, [group, "u"]).filter("v <> _low").select(
        group, F.col("v").alias("u"), F.col("_low").alias("v"))
    kept = lowest.select(group, "u", F.col("_low").alias("v"))
    return moved.unionByName(kept).distinct()
