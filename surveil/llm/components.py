"""Connected components by star contraction (large-star / small-star), every round staged."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Nodes with a third of all links are reduced before the shuffle where they are grouped, and
    left to adaptive skew handling where they are joined. Links may repeat and may be loops.
    """
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = stage(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        moved = large.join(least, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = stage(moved.unionByName(least.withColumnRenamed("low", "v")).distinct(), "small")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
