"""What follows from cluster labels: members of windows, summaries, last assignments."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.constants import CLUSTER_WINDOW_MINUTES
from surveil.functions.clock import window_end
from surveil.operators.keyed import latest_per_key


def window_members(events: DataFrame, minutes: int = CLUSTER_WINDOW_MINUTES,
                   slide: int | None = None) -> DataFrame:
    """One row per event and window ``(window_end - minutes, window_end]`` that holds it.

    Windows end at every multiple of ``slide`` (default: tumbling), so a window never depends
    on how the input was batched.
    """
    return events.withColumn("window_end", window_end(F.col("event_time"), minutes, slide))


def cluster_summary(labelled: DataFrame) -> DataFrame:
    """One row per cluster: its most frequent region (ties: smallest id), centre, size, cases.

    Sums per region first, so the region count is a by-product and one crowded cluster is
    reduced before it meets in one group.
    """
    per_region = labelled.filter("in_cluster").groupBy("window_end", "cluster_no", "cluster_id", "region").agg(
        F.count("*").alias("n"), F.sum("latitude").alias("lat"), F.sum("longitude").alias("lon"),
        F.sum("case_count").alias("cases"))
    return per_region.groupBy("window_end", "cluster_no", "cluster_id").agg(
        F.min(F.struct(-F.col("n"), F.col("region"))).getField("region").alias("region"),
        F.sum("n").alias("event_count"), F.sum("lat").alias("lat"), F.sum("lon").alias("lon"),
        F.sum("cases").alias("total_cases"),
    ).selectExpr("cluster_id", "window_end", "region", "lat / event_count AS center_latitude",
                 "lon / event_count AS center_longitude", "event_count", "total_cases")


def latest_assignment(labelled: DataFrame) -> DataFrame:
    """Each event's cluster in the last window that included it."""
    return latest_per_key(labelled.select("event_id", "window_end", "cluster_id", "in_cluster"),
                          "event_id", "window_end")
