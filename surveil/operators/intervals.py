"""Events and windows that end at any time: an interval join by time bins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.constants import CLUSTER_WINDOW_MINUTES
from surveil.operators.skew import ROWS_PER_SALT, hot_keys, salted_join
from surveil.session import stage


def members_at(events: DataFrame, ends: DataFrame, minutes: int = CLUSTER_WINDOW_MINUTES, key: str = "event_id") -> DataFrame:
    """``events`` with ``window_end``, one row per window of ``ends`` (window_end) that holds the event.

    A window holds ``window_end - minutes < event_time <= window_end``. Bins are as wide as a window,
    so a window meets two of them and the join is by equal bins; a bin is as full as its busiest
    hour, so crowded bins are split by event and the few windows beside them repeated. Nulls on
    either side match nothing; repeated ends count once.
    """
    width = F.lit(minutes * 60_000_000)
    binned = events.filter("event_time IS NOT NULL").withColumn("_bin", F.floor(F.unix_micros(F.col("event_time").cast("timestamp")) / width))
    sizes = stage(binned.groupBy("_bin").agg(F.count("*").alias("n")), "bins")
    largest = sizes.agg(F.max("n")).first()[0] or 0
    last = F.floor(F.unix_micros(F.col("window_end").cast("timestamp")) / width)
    windows = ends.filter("window_end IS NOT NULL").select("window_end").distinct().withColumn("_bin", F.explode(F.array(last - 1, last)))
    starts = F.col("window_end") - F.expr(f"INTERVAL {minutes} MINUTES")
    met = salted_join(binned, windows, ["_bin"], hot_keys(sizes, ["_bin"], "n") if largest > ROWS_PER_SALT else None, key)
    return met.filter((F.col("event_time") > starts) & (F.col("event_time") <= F.col("window_end"))).drop("_bin")
