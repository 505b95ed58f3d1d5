"""Events inside known outbreaks: an interval in time and a radius in space."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.functions import geo


def outbreak_members(reports: DataFrame, outbreaks: DataFrame, same_symptom: bool = False) -> DataFrame:
    """``reports`` with each outbreak (start <= time < end, within its radius) they belong to.

    Every outbreak is listed under the hours it touches, so the interval join becomes an
    equi-join on the hour; the exact bounds are checked after it. An hour that holds much of
    the feed is split by adaptive execution, as the side it meets is a handful of outbreaks.
    """
    hours = outbreaks.withColumn("_hour", F.explode(F.expr(
        "sequence(date_trunc('hour', start_time), date_trunc('hour', end_time), INTERVAL 1 HOUR)")))
    if same_symptom:
        hours = hours.withColumnRenamed("symptom_category", "_symptom")
    found = (
        reports.withColumn("_hour", F.date_trunc("hour", "event_time")).join(hours, "_hour")
        .filter("event_time >= start_time AND event_time < end_time")
        .withColumn("distance_km", geo.haversine_km("latitude", "longitude", "center_latitude", "center_longitude"))
        .filter("distance_km <= radius_km"))
    return (found.filter("symptom_type = _symptom").drop("_symptom") if same_symptom else found).drop("_hour")
