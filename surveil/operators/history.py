"""Case counts per time bin, for one series or many."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.constants import BIN_MINUTES, FORECAST_MIN_BINS, TICK_MINUTES
from surveil.functions.clock import floor_to


def _span(reports: DataFrame, minutes: int) -> DataFrame:
    """One row: first bin and last complete bin of the whole feed.

    The newest bin is complete once its last tick has arrived.
    """
    bucket = f"INTERVAL {minutes} MINUTES"
    ends = reports.agg(F.min("event_time").alias("oldest"), F.max("event_time").alias("newest"))
    return (
        ends.withColumn("first_bin", floor_to(F.col("oldest"), minutes))
        .withColumn("bin", floor_to(F.col("newest"), minutes))
        .selectExpr("first_bin", f"IF(newest < bin + INTERVAL {minutes - TICK_MINUTES} MINUTES,"
                                 f" bin - {bucket}, bin) AS last_bin")
    )


def case_history(reports: DataFrame, minutes: int = BIN_MINUTES) -> DataFrame:
    """(ds, y): cases per bin; bins without reports are 0, an unfinished last bin is left out."""
    bins = _span(reports, minutes).filter("last_bin >= first_bin").select(
        F.explode(F.sequence("first_bin", "last_bin", F.expr(f"INTERVAL {minutes} MINUTES"))).alias("ds"))
    counts = reports.groupBy(floor_to(F.col("event_time"), minutes).alias("ds")).agg(
        F.sum("case_count").alias("y"))
    return bins.join(counts, "ds", "left").select("ds", F.coalesce("y", F.lit(0)).cast("double").alias("y"))


def series_history(reports: DataFrame, minutes: int = BIN_MINUTES) -> DataFrame:
    """(kind, name, x, ds, y) for the total, each region and each symptom type.

    A series starts at its own first bin and ends at the last complete bin of the feed;
    ``x`` numbers its bins from 0. Reports are summed once, then shared by the three kinds.
    """
    ds = floor_to(F.col("event_time"), minutes).alias("ds")
    fine = reports.groupBy(ds, "region", "symptom_type").agg(F.sum("case_count").alias("y"))
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), name.alias("name")) for kind, name in (
        ("total", F.lit("all")), ("region", F.col("region")), ("symptom", F.col("symptom_type")))])
    counts = fine.select("ds", "y", F.inline(kinds)).groupBy("kind", "name", "ds").agg(F.sum("y").alias("y"))
    last = _span(reports, minutes).select("last_bin")
    step = F.expr(f"INTERVAL {minutes} MINUTES")
    # one row per series; the last bin is one value for all of them
    starts = counts.groupBy("kind", "name").agg(F.min("ds").alias("first_bin")).withColumn(
        "last_bin", last.scalar()).filter("last_bin >= first_bin")
    bins = starts.select("kind", "name", F.posexplode(F.sequence("first_bin", "last_bin", step)).alias("x", "ds"))
    return bins.join(counts, ["kind", "name", "ds"], "left").select(
        "kind", "name", "x", "ds", F.coalesce("y", F.lit(0)).cast("double").alias("y"))


def eligibility(history: DataFrame, minimum: int = FORECAST_MIN_BINS) -> DataFrame:
    """(kind, name, bins, eligible): series with too little history are reported, not fitted."""
    return history.groupBy("kind", "name").agg(F.count("*").alias("bins")).withColumn(
        "eligible", F.col("bins") >= minimum)


def require_history(history: DataFrame, minimum: int = FORECAST_MIN_BINS) -> int:
    """Number of bins of a single series; an error when there are too few."""
    bins = history.count()
    if bins < minimum:
        raise ValueError(f"Only {bins} complete bins of history; at least {minimum} are needed.")
    return bins
