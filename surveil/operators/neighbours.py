"""Exact numbers of neighbours within a radius, by counting strips of latitude.

An event belongs to one block of a coarse grid and is sent, as a position to be counted, to every
other block that reaches within the radius of it. That one shuffle brings together all a block
needs, so no pair of positions is ever a row. In the task the positions of a block lie in strips of
latitude, ordered by longitude. What a strip holds within the radius of an event is a range: its
inner part, safely inside, is counted by its two ends, and only positions between the inner and
the outer bound are compared. Strips are narrower where positions crowd, so an event costs about
the square root of what it counts.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from surveil.constants import CLUSTER_EPS_KM, EARTH_RADIUS_KM
from surveil.functions import geo
from surveil.operators.skew import ROWS_PER_SALT, hot_keys
from surveil.operators.validate import without_labels
from surveil.session import release_shuffles, stage

# Up to this many pairs of positions a block is compared directly. It moves work between two ways
# of the same exact count, as do the other sizes here.
PAIRWISE_LIMIT = 1024
BLOCK = 8                    # a block is at most so many radii wide
ROWS_HELD = 1 << 18          # positions counted at a time
_CHUNK = 1 << 18             # strips, or positions compared, at a time
_BY_ENDS = 8                 # a range of more positions is worth an inner part
_UNITS = 1 << 24             # longitudes are ordered by so many steps a degree
_STRIPS = 8192               # of a group, about
_CIRCLE, _STRIP = 360 * _UNITS, 1 << 33
_SLACK = 1e-9
_BLOCK = ["window_end", "block"]
_SPOT = ["window_end", "latitude", "longitude"]


def _spots(order: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows sorted by (group, latitude, longitude), where each distinct one begins, and each row's number."""
    group, lat, lon = order
    by = np.lexsort((lon, lat, group))
    new = np.ones(len(by), dtype=bool)
    new[1:] = (np.diff(group[by]) != 0) | (np.diff(lat[by]) != 0) | (np.diff(lon[by]) != 0)
    number = np.empty(len(by), dtype=np.int64)
    number[by] = np.cumsum(new) - 1
    return by, np.flatnonzero(new), number


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number of the ranges [first, last), and the range it is from."""
    n = last - first
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) + np.repeat(first - (np.cumsum(n) - n), n), of


def _chunks(n: np.ndarray):
    """Slices of rows that stand for about _CHUNK rows together, one row at least."""
    total, at = np.cumsum(n), 0
    while at < len(n):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _CHUNK, "right")))
        yield slice(at, end)
        at = end


def _half_sine(degrees: np.ndarray) -> np.ndarray:
    """Square of the sine of half an angle."""
    return np.square(np.sin(degrees * (math.pi / 360)))


def _crowding(group: np.ndarray, lat: np.ndarray, lon: np.ndarray, eps: float, groups: int) -> np.ndarray:
    """Positions that share a square as wide as eps with a position, on average in a group."""
    row, column = np.floor(lat / eps), np.floor(lon * np.cos(np.radians(lat)) / eps)
    by, first, _ = _spots((group, row, column))
    n = np.diff(np.append(first, len(by)))
    return np.bincount(group[by][first], n * n, groups) / np.maximum(np.bincount(group, minlength=groups), 1)


def count_near(eps_km: float, pairwise: int, at: tuple[np.ndarray, ...], near: tuple[np.ndarray, ...], n: np.ndarray) -> np.ndarray:
    """For every row of ``at``, (group, latitude, longitude), the sum of ``n`` over the rows of ``near`` in its group within eps."""
    if not len(at[0]) or not len(n):
        return np.zeros(len(at[0]), dtype=np.int64)
    by, first, number = _spots(at)
    group, lat, lon = (x[by][first] for x in at)
    lowest = min(group[0], near[0].min())
    groups = max(group[-1], near[0].max()) - lowest + 1
    group = group - lowest
    by, first, _ = _spots(near)
    s_group, s_lat, s_lon = (x[by][first] for x in near)
    s_group, s_n = s_group - lowest, np.add.reduceat(n[by], first)
    asked = np.bincount(group, minlength=groups)
    kept = asked[s_group] > 0
    s_group, s_lat, s_lon, s_n = s_group[kept], s_lat[kept], s_lon[kept], s_n[kept]
    found = np.zeros(len(group), dtype=np.int64)
    if not len(s_n):
        return found[number]

    # strips: one for a small block, else the more the more positions a radius holds
    eps = math.degrees(eps_km / EARTH_RADIUS_KM) * (1 + _SLACK) + _SLACK
    turn, s_turn = np.mod(lon + 180, 360.0), np.mod(s_lon + 180, 360.0)
    strips = np.clip(np.ceil(np.sqrt(_crowding(s_group, s_lat, s_turn, eps, groups))), 2, 1024)
    size = np.bincount(s_group, minlength=groups)
    ends = np.cumsum(size)
    first, last = np.minimum(ends - size, len(s_lat) - 1), np.maximum(ends - 1, 0)           # positions go up in a group
    height = np.where(asked * size <= pairwise, 360.0, np.maximum(2 * eps / strips, (s_lat[last] - s_lat[first]) / _STRIPS))
    row = np.floor((s_lat + 90) / height[s_group]).astype(np.int64)
    low, high = row[first], row[last]
    offset = np.cumsum(np.where(size > 0, high - low + 1, 0)) - high - 1                     # strip = row + offset
    r, of = _ranges(low[size > 0], high[size > 0] + 1)
    h = height[size > 0][of]
    south, north = np.maximum(r * h - 90 - _SLACK, -90), np.minimum((r + 1) * h - 90 + _SLACK, 90)
    thinnest, widest = np.sort([np.cos(np.radians(south)), np.cos(np.radians(north))], axis=0)
    widest[(south <= 0) & (north >= 0)] = 1.0
    key = (row + offset[s_group]) * _STRIP + np.floor(s_turn * _UNITS).astype(np.int64)
    by = np.argsort(key, kind="stable")
    key, s_lat, s_lon, s_n = key[by], s_lat[by], s_lon[by], s_n[by]
    s_cos, total, single = np.cos(np.radians(s_lat)), np.append(0, np.cumsum(s_n)), bool((s_n == 1).all())
    cos, chord = np.cos(np.radians(lat)), math.sin(eps_km / EARTH_RADIUS_KM / 2) ** 2
    inside, outside = chord * (1 - _SLACK), chord * (1 + _SLACK)

    def reach(ratio):
        return np.degrees(2 * np.arcsin(np.sqrt(np.clip(ratio, 0, 1))))

    def add(of, n):
        if len(of):
            lowest = of.min()
            sums = np.bincount(of - lowest, n)
            found[lowest:lowest + len(sums)] += sums.astype(np.int64)

    def compare(a, b, of):
        """Adds what ranges [a, b) hold within eps of the positions ``of``."""
        some = b > a
        a, b, of = a[some], b[some], of[some]
        for part in _chunks(b - a):
            i, k = _ranges(a[part], b[part])
            k = of[part][k]
            x = _half_sine(s_lat[i] - lat[k]) + cos[k] * s_cos[i] * _half_sine(s_lon[i] - lon[k])
            hit = x <= inside
            unsure = np.flatnonzero(~hit & (x <= outside))
            hit[unsure] = 2 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(x[unsure], 1.0))) <= eps_km
            add(k, hit if single else hit * s_n[i])

    start = np.maximum(np.floor((lat - eps + 90) / height[group]).astype(np.int64), low[group])
    end = np.minimum(np.floor((lat + eps + 90) / height[group]).astype(np.int64), high[group]) + 1
    end = np.where(size[group] > 0, np.maximum(start, end), start)
    for part in _chunks(end - start):
        r, t = _ranges(start[part], end[part])
        t += part.start
        strip, here = r + offset[group[t]], lat[t]
        with np.errstate(divide="ignore", invalid="ignore"):
            outer = (outside - _half_sine(np.maximum(np.maximum(south[strip] - here, here - north[strip]), 0))) / (cos[t] * thinnest[strip])
            inner = (inside - _half_sine(np.maximum(north[strip] - here, here - south[strip]))) / (cos[t] * widest[strip])
        lon_out, lon_in, x = reach(outer), reach(inner), turn[t]
        whole = lon_out >= 180 - 1e-6
        a = np.where(whole, 0, np.floor((x - lon_out) * _UNITS) - 1).astype(np.int64)
        d = np.where(whole, _CIRCLE, np.floor((x + lon_out) * _UNITS) + 1).astype(np.int64)
        b = np.where(inner >= 1, 0, np.floor((x - lon_in) * _UNITS) + 2).astype(np.int64)
        c = np.where(inner >= 1, _CIRCLE, np.floor((x + lon_in) * _UNITS) - 1).astype(np.int64)
        in_reach = outer >= 0
        for shift, some in ((0, in_reach), (_CIRCLE, in_reach & (a < 0)), (-_CIRCLE, in_reach & (d > _CIRCLE))):
            if not some.any():
                continue
            base, of = strip[some] * _STRIP, t[some]
            first = np.searchsorted(key, base + np.clip(a[some] + shift, 0, _CIRCLE), "left")
            last = np.searchsorted(key, base + np.clip(d[some] + shift, 0, _CIRCLE), "right")
            long = last - first > _BY_ENDS
            compare(first[~long], last[~long], of[~long])
            base, of, first, last, b_in, c_in = base[long], of[long], first[long], last[long], b[some][long] + shift, c[some][long] + shift
            i = np.clip(np.searchsorted(key, base + np.clip(b_in, 0, _CIRCLE + 1), "left"), first, last)
            k = np.clip(np.searchsorted(key, base + np.clip(c_in, -1, _CIRCLE), "right"), i, last)
            add(of, total[k] - total[i])
            compare(np.concatenate([first, k]), np.concatenate([i, last]), np.concatenate([of, of]))
    return found[number]


class _Held:
    """Events of a task and the positions to count for them, by group, until they are counted."""

    def __init__(self, eps_km: float, pairwise: int):
        self.eps_km, self.pairwise = eps_km, pairwise
        self.ends, self.ids, self.at, self.degree, self.near, self.n = [], [], [], [], [], []

    def take(self, batch: pa.RecordBatch, group: np.ndarray, own: np.ndarray) -> None:
        """Adds the events of a batch, rows whose ``n`` is null, and its positions; events that are ``own`` are positions too."""
        event = batch.column("n").is_null()
        is_event = event.to_numpy(zero_copy_only=False)
        at = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in ("latitude", "longitude")])
        if is_event.any():
            self.ends.append(batch.column("window_end").filter(event))
            self.ids.append(batch.column("event_id").filter(event))
            self.at.append((group[is_event], *at[:, is_event]))
            self.degree.append(np.zeros(int(is_event.sum()), dtype=np.int64))
        if self.ids:                              # else nobody asks
            counts = ~is_event | own
            self.near.append((group[counts], *at[:, counts]))
            self.n.append(batch.column("n").fill_null(1).to_numpy(zero_copy_only=False)[counts])

    def rows(self, done: float, known: float) -> int:
        """Positions of groups below ``known`` that are held, or events of groups below ``done`` if they are more."""
        return max(*(sum(int((x[0] < below).sum()) for x in held) for held, below in ((self.near, known), (self.at, done))))

    def count(self, done: float, known: float, schema: pa.Schema) -> pa.RecordBatch:
        """Counts positions of groups below ``known``, whose events are all here; events of groups below ``done`` leave."""
        at, degree = tuple(np.concatenate(x) for x in zip(*self.at)), np.concatenate(self.degree)
        ends, ids, leave = pa.concat_arrays(self.ends), pa.concat_arrays(self.ids), at[0] < done
        near, n = self.near, self.n
        self.__init__(self.eps_km, self.pairwise)
        if near:                                  # else all was counted before
            near, n = tuple(np.concatenate(x) for x in zip(*near)), np.concatenate(n)
            now = near[0] < known
            degree += count_near(self.eps_km, self.pairwise, at, tuple(x[now] for x in near), n[now])
            if not now.all():
                self.near, self.n = [tuple(x[~now] for x in near)], [n[~now]]
        if not leave.all():
            stay = pa.array(~leave)
            self.ends, self.ids, self.at, self.degree = [ends.filter(stay)], [ids.filter(stay)], [tuple(x[~leave] for x in at)], [degree[~leave]]
        leaving = pa.array(leave)
        return pa.RecordBatch.from_arrays([ends.filter(leaving), ids.filter(leaving), pa.array(degree[leave])], schema=schema)


def _degrees(batches, eps_km: float, pairwise: int, rows_held: int):
    """Degrees of the events of a task. Rows come by group, its events before the positions to count.

    Groups are held until they make ``rows_held`` positions; the positions of a larger one are counted
    piece by piece, once its events are all here.
    """
    held, last, group, schema = _Held(eps_km, pairwise), None, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        schema = schema or pa.schema([batch.schema.field("window_end"), batch.schema.field("event_id"), pa.field("degree", pa.int64())])
        keys = np.stack([batch.column(k).cast(pa.int64()).to_numpy() for k in ("window_end", "block", "part")])
        groups = group + np.cumsum((np.diff(keys, axis=1, prepend=keys[:, :1] if last is None else last) != 0).any(axis=0))
        last, group = keys[:, -1:], int(groups[-1])
        held.take(batch, groups, keys[2] < 0)
        known = group + bool(batch.column("n")[-1].is_valid)
        if held.ids and held.rows(group, known) >= rows_held:
            yield held.count(group, known, schema)
    if held.ids:
        yield held.count(math.inf, math.inf, schema)


def neighbour_degree(members: DataFrame, eps_km: float = CLUSTER_EPS_KM) -> DataFrame:
    """(window_end, event_id, degree): neighbours within eps of every event of a window, itself included.

    Only a block with more than ROWS_PER_SALT events is divided among tasks: by event, and every
    part gets the positions of the block, each once.
    """
    eps, side = geo.check_eps(eps_km), BLOCK * eps_km
    placed = without_labels(members).select("window_end", "event_id", "latitude", "longitude").filter(
        "window_end IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) AND NOT isnan(longitude)")
    points = stage(geo.with_cell(placed, side, "block").drop("_lon"), "members", "zstd")
    release_shuffles(points.sparkSession)
    hot = stage(hot_keys(points.groupBy(*_BLOCK).agg(F.count("*").alias("n")), _BLOCK, "n", ROWS_PER_SALT), "hot")
    if hot.isEmpty():
        events, spots = points.withColumn("part", F.lit(-1)), points.select(*_SPOT, "block", F.lit(1).cast("long").alias("n"))
    else:
        events = points.join(hot, _BLOCK, "left").withColumn(
            "part", F.coalesce(F.pmod(F.xxhash64("event_id"), "_parts"), F.lit(-1)).cast("int")).drop("_parts")
        spots = points.join(hot, _BLOCK, "left_anti").select(*_SPOT, "block", F.lit(1).cast("long").alias("n")).unionByName(
            points.join(hot, _BLOCK, "left_semi").groupBy(*_SPOT, "block").agg(F.count("*").alias("n")))
    boxes = spots.withColumnRenamed("block", "home").withColumns({
        "min_lat": F.col("latitude"), "max_lat": F.col("latitude"),
        "min_lon": geo.wrap_longitude("longitude"), "max_lon": geo.wrap_longitude("longitude")})
    near = geo.explode_near_cells(boxes, side, eps, "block").drop(*geo.BOX)
    if hot.isEmpty():
        near = near.filter("block <> home").withColumn("part", F.lit(-1))
    else:
        near = near.join(hot, _BLOCK, "left").filter("block <> home OR _parts IS NOT NULL").withColumn(
            "part", F.explode(F.when(F.col("_parts").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("_parts") - 1)))).drop("_parts")
    columns = [*_BLOCK, "part", "event_id", "latitude", "longitude", "n"]
    event_id = points.schema["event_id"]
    rows = events.withColumn("n", F.lit(None).cast("long")).select(*columns).unionByName(
        near.withColumn("event_id", F.lit(None).cast(event_id.dataType)).select(*columns))
    gathered = rows.repartition(*_BLOCK, "part").sortWithinPartitions(*_BLOCK, "part", F.col("n").asc_nulls_first())
    pairwise, held = PAIRWISE_LIMIT, ROWS_HELD
    return gathered.mapInArrow(lambda batches: _degrees(batches, eps, pairwise, held), StructType([
        points.schema["window_end"], event_id, StructField("degree", LongType())]))
