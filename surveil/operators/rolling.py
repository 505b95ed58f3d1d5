"""Verdicts on arrival without a copy of every event per window: rolling counts by differences.

The window of an event ends when it arrives, so there are as many windows as arrival times. A
grid cell whose points are all neighbours needs no more than a count per time: it goes up when
events arrive and down when they leave the window, and the running sum of these differences is
the count at every time. Where that count reaches ``min_samples`` every event of the cell is core.
Only arrivals in sparser cells are looked at: against the boxes of one cell and one arrival time
first, and point by point where a box does not decide or the cell is sparse. Points are never
repeated per window; a probe meets a point at most once.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveil.constants import CLUSTER_EPS_KM, CLUSTER_MIN_SAMPLES, CLUSTER_WINDOW_MINUTES
from surveil.functions import geo
from surveil.operators.skew import ROWS_PER_SALT, hot_keys, salted_join
from surveil.session import stage

_TIMES = ["cell", "event_time"]


def rolling_counts(counts: DataFrame, keys: list[str], minutes: int) -> DataFrame:
    """(keys, since, until, n): how many of ``counts`` (keys, event_time, n) lie in the window
    ``(t - minutes, t]``, for every ``t`` with ``since <= t < until``; empty windows have no row.

    One row per key and change: what arrives is added, what leaves is taken off.
    """
    leaves = F.col("event_time") + F.expr(f"INTERVAL {minutes} MINUTES")
    both = F.explode(F.array(F.struct(F.col("event_time").alias("since"), F.col("n").alias("d")), F.struct(leaves.alias("since"), (-F.col("n")).alias("d"))))
    changes = counts.select(*keys, both.alias("x")).select(*keys, "x.*").groupBy(*keys, "since").agg(F.sum("d").alias("d"))
    along = Window.partitionBy(*keys).orderBy("since")
    return changes.select(*keys, "since", F.lead("since").over(along).alias("until"), F.sum("d").over(along).alias("n")).filter("n > 0")


def _bin(time: str, minutes: int):
    return F.floor(F.unix_micros(F.col(time).cast("timestamp")) / F.lit(minutes * 60_000_000))


class _Replay:
    """Staged tables that both rounds of probes use."""

    def __init__(self, points: DataFrame, minutes: int, eps_km: float, m: int):
        self.minutes, self.eps, self.side, self.m = minutes, geo.check_eps(eps_km), eps_km / 1.5, m
        self.points = stage(geo.with_cell(points, self.side), "points")
        boxes = self.points.groupBy(*_TIMES).agg(F.count("*").alias("n"), F.min("latitude").alias("min_lat"), F.max("latitude").alias("max_lat"),
                                                 F.min("_lon").alias("min_lon"), F.max("_lon").alias("max_lon"))
        boxes = stage(boxes.withColumn("bin", _bin("event_time", minutes)), "boxes")
        self.boxes = boxes
        rolling = stage(rolling_counts(boxes, ["cell"], minutes), "rolling")
        # an interval with events in it is no longer than the window, so it meets two bins at most
        bins = F.array_distinct(F.array(_bin("since", minutes), F.floor((F.unix_micros(F.col("until").cast("timestamp")) - 1) / F.lit(minutes * 60_000_000))))
        self.counts = rolling.select("cell", "since", "until", F.col("n").alias("around"), F.explode(bins).alias("bin"))
        self.arrivals = boxes.join(rolling.select("cell", F.col("since").alias("event_time"), F.col("n").alias("around")), _TIMES)
        largest = boxes.agg(F.max("n")).first()[0] or 0
        self.hot = hot_keys(boxes, _TIMES, "n") if largest > ROWS_PER_SALT else None

    def probe(self, probes: DataFrame) -> DataFrame:
        """(s, at, around, t, found and t's place): neighbours of ``probes`` (s, at, s_latitude, s_longitude, s_lon)
        in the window that ends at ``at``. In a cell with ``around`` >= m whole boxes are counted without ``t``.
        """
        spot = probes.select("s", "at", "s_latitude", "s_longitude", *[F.col(c).alias(n) for n, c in zip(geo.BOX, ("s_latitude", "s_latitude", "s_lon", "s_lon"))])
        near = geo.explode_near_cells(spot, self.side, self.eps, "cell").withColumn("bin", _bin("at", self.minutes))
        near = near.join(self.counts, ["cell", "bin"]).filter((F.col("since") <= F.col("at")) & (F.col("at") < F.col("until"))).drop("since", "until")
        near = near.withColumnsRenamed({n: f"s_{n}" for n in geo.BOX}).withColumn("bin", F.explode(F.array(F.col("bin"), F.col("bin") - 1)))
        boxes = self.boxes.withColumnsRenamed({n: f"b_{n}" for n in geo.BOX})
        starts = F.col("at") - F.expr(f"INTERVAL {self.minutes} MINUTES")
        met = geo.with_distance_bounds(near.join(boxes, ["cell", "bin"]).filter((F.col("event_time") <= F.col("at")) & (F.col("event_time") > starts)), "s_", "b_").filter(
            F.col("lower_km") <= self.eps)
        whole = (F.col("around") >= self.m) & (F.col("upper_km") <= self.eps)
        met = met.select("s", "at", "s_latitude", "s_longitude", "around", "n", *_TIMES, whole.alias("whole"))
        nothing = self.points.select(F.lit(None).cast(self.points.schema["event_id"].dataType).alias("t"), *[
            F.lit(None).cast("double").alias(n) for n in ("latitude", "longitude", "_lon")]).schema
        counted = met.filter("whole").select("s", "at", "around", *[F.lit(None).cast(f.dataType).alias(f.name) for f in nothing], F.col("n").alias("found"))
        there = self.points.select(F.col("event_id").alias("t"), *_TIMES, "latitude", "longitude", "_lon")
        close = salted_join(there, met.filter("NOT whole").drop("whole", "n"), _TIMES, self.hot, "t").filter(
            geo.haversine_km("s_latitude", "s_longitude", "latitude", "longitude") <= self.eps)
        return counted.unionByName(close.select("s", "at", "around", "t", "latitude", "longitude", "_lon", F.lit(1).cast("long").alias("found")))


def verdicts_on_arrival(points: DataFrame, minutes: int = CLUSTER_WINDOW_MINUTES, eps_km: float = CLUSTER_EPS_KM,
                        min_samples: int = CLUSTER_MIN_SAMPLES) -> DataFrame:
    """(event_id, event_time, in_cluster) of (event_id, event_time, latitude, longitude).

    An event is in a cluster when it or a neighbour has ``min_samples`` neighbours, itself
    included, among the events of ``(event_time - minutes, event_time]``. Event ids are unique.
    """
    replay = _Replay(points.select("event_id", "event_time", "latitude", "longitude"), minutes, eps_km, min_samples)
    placed = stage(salted_join(replay.points, replay.arrivals.select(*_TIMES, "around"), _TIMES, replay.hot, "event_id"), "arrivals")
    sparse = placed.filter(F.col("around") < min_samples)
    links = stage(replay.probe(sparse.select(
        F.col("event_id").alias("s"), F.col("event_time").alias("at"), F.col("latitude").alias("s_latitude"), F.col("longitude").alias("s_longitude"), F.col("_lon").alias("s_lon"))), "links")
    dense = F.col("around") >= min_samples
    first = links.groupBy("s").agg((F.bool_or(dense) | (F.sum("found") >= min_samples)).alias("hit"))
    # what is left hangs on a neighbour in a sparse cell being core at that time
    asked = links.join(first.filter("NOT hit").select("s"), "s", "left_semi").filter("t <> s")
    asked = stage(asked.select("s", "at", "t", "latitude", "longitude", "_lon"), "asked")
    again = replay.probe(asked.select(F.col("t").alias("s"), "at", F.col("latitude").alias("s_latitude"), F.col("longitude").alias("s_longitude"), F.col("_lon").alias("s_lon")).distinct())
    core = again.groupBy("s", "at").agg(F.sum("found").alias("n")).filter(F.col("n") >= min_samples).select(F.col("s").alias("t"), "at")
    hits = asked.join(core, ["t", "at"]).select("s").unionByName(first.filter("hit").select("s")).distinct()
    few = sparse.join(hits.select(F.col("s").alias("event_id"), F.lit(True).alias("_hit")), "event_id", "left").select(
        "event_id", "event_time", F.coalesce("_hit", F.lit(False)).alias("in_cluster"))
    return few.unionByName(placed.filter(F.col("around") >= min_samples).select("event_id", "event_time", F.lit(True).alias("in_cluster")))
