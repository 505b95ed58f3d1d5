"""Ranks inside groups without one task per group."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveil.session import stage

_INDEX_BITS = 33  # of monotonically_increasing_id: partition number above, row number below


def ranked(rows: DataFrame, keys: list[str], order: list, name: str = "ranked", rank: str = "rank") -> DataFrame:
    """``rows`` plus each row's number (from 1) inside its group, by ``order``.

    Rows are range-partitioned and sorted, so a group with a third of all rows spreads over many
    tasks; the offsets of the tasks come from one row per group and task. ``keys`` must not hold
    nulls. Rows that tie in ``order`` are numbered as they happen to lie.
    """
    ordered = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = stage(ordered.withColumn("_at", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("_task", F.shiftright("_at", _INDEX_BITS)).withColumn(
        "_at", F.col("_at").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)))
    parts = placed.groupBy(*keys, "_task").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*keys, "_task", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return placed.join(parts, [*keys, "_task"]).withColumn(rank, F.col("_at") + F.col("_shift")).drop("_at", "_task", "_shift")
