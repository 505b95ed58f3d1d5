"""Regional risk per window."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveil.constants import REGION_IDS
from surveil.functions.risk import risk_columns
from surveil.operators.clusters import window_members
from surveil.operators.dbscan import core_and_members

REPORT_COLUMNS = ["event_id", "event_time", "region", "latitude", "longitude", "case_count"]


def risk_of_windows(members: DataFrame, readings: DataFrame, minutes: int = 60,
                    slide: int | None = None) -> DataFrame:
    """Six rows per window of clustered ``members`` (with ``in_cluster``), one per known region.

    Readings, cases and the rows every region must have are put into one grouping, so there
    is one shuffle of already reduced rows and no join.
    """
    flags = window_members(readings.select("event_time", "region", "predicted_anomaly"), minutes, slide).groupBy(
        "window_end", "region").agg(F.count("*").alias("readings"),
                                    F.count_if(F.col("predicted_anomaly")).alias("flagged"))
    cases = members.filter("in_cluster").groupBy("window_end", "region").agg(
        F.sum("case_count").alias("cases"))
    frame = members.select("window_end").distinct().select(
        "window_end", F.explode(F.array(*map(F.lit, REGION_IDS))).alias("region"), F.lit(1).alias("dense"))
    counts = frame.unionByName(flags, allowMissingColumns=True).unionByName(
        cases, allowMissingColumns=True).groupBy("window_end", "region").agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("dense", "readings", "flagged", "cases")]
    ).filter("dense > 0")
    rate = F.expr("IF(readings = 0, 0.0D, flagged / CAST(readings AS DOUBLE))")
    risk = risk_columns(F.col("_rate"), F.col("cases"))
    return counts.withColumn("_rate", rate).select(
        "region", "window_end", F.bround("_rate", 4).alias("anomaly_rate"),
        F.col("cases").alias("clustered_cases"), *[column.alias(name) for name, column in risk.items()])


def region_risk(readings: DataFrame, reports: DataFrame, minutes: int = 60, slide: int | None = None) -> DataFrame:
    """Cluster the reports of every window, then score every region."""
    members = core_and_members(window_members(reports.select(*REPORT_COLUMNS), minutes, slide))
    return risk_of_windows(members, readings, minutes, slide)


def in_latest_window(newest: DataFrame, minutes: int = 60) -> Column:
    """Condition on ``event_time``: in the window that holds the newest of the given times.

    It is a scalar subquery, so it can stand below a dedupe: one window is shuffled instead of all.
    """
    end = window_members(newest.agg(F.max("event_time").alias("event_time")), minutes).select("window_end").scalar()
    return (F.col("event_time") <= end) & (F.col("event_time") > end - F.expr(f"INTERVAL {minutes} MINUTES"))


def latest_window_only(events: DataFrame, newest: DataFrame, minutes: int = 60) -> DataFrame:
    """Events of the window that holds the newest report.

    ``newest`` is the reports' own times: the filter is a scalar subquery, so only one
    window is clustered instead of all.
    """
    return events.filter(in_latest_window(newest, minutes))
