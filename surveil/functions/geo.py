"""Distances on the sphere, and the grid that turns radius search into equi-joins.

A grid cuts the sphere into rows of equal height and each row into equal columns,
wrapping at +-180 degrees. No cell is longer than the given side, so

* with a side of ``eps / 1.5`` two points of one cell are always closer than ``eps`` (the
  diagonal is ``0.943 eps``; this holds on the sphere for every ``eps`` up to the radius), and
* all points within ``eps`` of a cell lie in a bounded number of cells around it.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveil.constants import EARTH_RADIUS_KM, KM_PER_DEGREE, REGIONS

_COLUMN_BITS = 1 << 31   # cell id = row * 2^31 + column
_SLACK = 1e-9            # safety margin of bounds against rounding
BOX = ["min_lat", "max_lat", "min_lon", "max_lon"]


def _d(value: float) -> str:
    """A DOUBLE literal (plain decimals would be DECIMAL)."""
    return f"{value!r}D"


def _arc_km(half_lat: str, half_lon: str, lat1: str, lat2: str) -> str:
    """Haversine formula from half differences (degrees) and the two latitudes."""
    chord = (f"pow(sin(radians({half_lat})), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
             f" * pow(sin(radians({half_lon})), 2)")
    return f"{_d(2 * EARTH_RADIUS_KM)} * asin(sqrt(least({chord}, 1.0D)))"


def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Great-circle distance between two positions, given as SQL expressions in degrees."""
    return F.expr(_arc_km(f"(({lat2}) - ({lat1})) / 2", f"(({lon2}) - ({lon1})) / 2", lat1, lat2))


def offset_latitude(lat: str, north_km: str) -> Column:
    return F.expr(f"bround({lat} + ({north_km}) / {_d(KM_PER_DEGREE)}, 6)")


def offset_longitude(lat: str, lon: str, east_km: str) -> Column:
    return F.expr(f"bround({lon} + ({east_km}) / ({_d(KM_PER_DEGREE)} * cos(radians({lat}))), 6)")


def nearest_region(lat: str, lon: str) -> Column:
    """Struct (distance_km, position, region) of the closest centre; ties go to list order."""
    return F.array_min(F.array(*[
        F.struct(haversine_km(lat, lon, _d(r_lat), _d(r_lon)).alias("distance_km"),
                 F.lit(position).alias("position"), F.lit(region).alias("region"))
        for position, (region, _, r_lat, r_lon) in enumerate(REGIONS)
    ]))


def check_eps(eps_km: float) -> float:
    if not 0 < eps_km <= EARTH_RADIUS_KM:
        raise ValueError(f"eps must be above 0 and at most {EARTH_RADIUS_KM} km, not {eps_km}")
    return eps_km


def _row_height(side_km: float) -> float:
    return math.degrees(side_km / EARTH_RADIUS_KM)


def _columns_in_row(row: str, height: float) -> str:
    """Number of columns of a row: narrow enough for its widest parallel."""
    low, high = f"({row} * {_d(height)} - 90)", f"(({row} + 1) * {_d(height)} - 90)"
    widest = f"cos(radians({_near_equator(low, high)}))"
    return f"greatest(CAST(ceil(360 * {widest} / {_d(height)}) AS BIGINT), 1L)"


def _near_equator(low: str, high: str) -> str:
    """Smallest absolute latitude between two parallels."""
    return f"CASE WHEN {low} <= 0 AND {high} >= 0 THEN 0.0D ELSE least(abs({low}), abs({high})) END"


def wrap_longitude(lon: str) -> Column:
    """Longitude moved to [0, 360)."""
    return F.expr(f"pmod({lon} + 180, 360.0D)")


def with_cell(points: DataFrame, side_km: float, name: str = "cell") -> DataFrame:
    """Adds ``_lon`` (wrapped longitude) and a cell id for the columns latitude and longitude."""
    height = _row_height(side_km)
    return (
        points.withColumns({"_lon": wrap_longitude("longitude"),
                            "_row": F.expr(f"floor((latitude + 90) / {_d(height)})")})
        .withColumn("_columns", F.expr(_columns_in_row("_row", height)))
        .withColumn(name, F.expr(
            f"_row * {_COLUMN_BITS}L + least(floor(_lon / (360.0D / _columns)), _columns - 1)"))
        .drop("_row", "_columns")
    )


def explode_near_cells(boxes: DataFrame, side_km: float, eps_km: float, into: str) -> DataFrame:
    """One row per cell that may hold points within ``eps_km`` of the row's box.

    ``boxes`` carries the columns of ``BOX`` (longitudes wrapped to [0, 360)). With a side of
    eps / 1.5 about 21 cells come out per box, with a side of eps about 9.
    """
    height = _row_height(side_km)
    eps = math.degrees(eps_km / EARTH_RADIUS_KM) * (1 + _SLACK) + _SLACK
    last_row = math.floor(180.0 / height)
    rows = (f"explode(sequence(greatest(floor((min_lat - {_d(eps)} + 90) / {_d(height)}), 0L),"
            f" least(floor((max_lat + {_d(eps)} + 90) / {_d(height)}), {last_row}L)))")
    far = "greatest(abs(min_lat), abs(max_lat))"
    reach = (f"CASE WHEN {far} + {_d(eps)} >= 90 THEN 180.0D ELSE degrees(asin(least("
             f"{_d(math.sin(math.radians(eps)))} / cos(radians({far})), 1.0D))) + {_d(_SLACK)} END")
    first = "floor((min_lon - _reach) / (360.0D / _columns))"
    last = "floor((max_lon + _reach) / (360.0D / _columns))"
    columns = (f"explode(CASE WHEN {last} - {first} + 1 >= _columns THEN sequence(0L, _columns - 1)"
               f" ELSE sequence({first}, {last}) END)")
    return (
        boxes.withColumns({"_row": F.expr(rows), "_reach": F.expr(reach)})
        .withColumn("_columns", F.expr(_columns_in_row("_row", height)))
        .withColumn("_column", F.expr(columns))
        .withColumn(into, F.expr(f"_row * {_COLUMN_BITS}L + pmod(_column, _columns)"))
        .drop("_row", "_reach", "_columns", "_column")
    )


def with_distance_bounds(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Adds ``lower_km`` and ``upper_km``: bounds of the distance between points of two boxes.

    ``a`` and ``b`` are column prefixes. Each haversine term is bounded on its own, so the
    bounds are safe on the sphere; points are boxes without extent.
    """
    def around(x):
        return f"least(abs({x}), 360 - abs({x}))"

    def far(p):
        return f"greatest(abs({p}min_lat), abs({p}max_lat))"

    def near(p):
        return _near_equator(f"{p}min_lat", f"{p}max_lat")

    lon_gap = (f"CASE WHEN {a}min_lon <= {b}max_lon AND {b}min_lon <= {a}max_lon THEN 0.0D ELSE "
               f"least({around(f'({b}min_lon - {a}max_lon)')}, {around(f'({a}min_lon - {b}max_lon)')}) END")
    lon_span = f"least(_lon_gap + {a}max_lon - {a}min_lon + {b}max_lon - {b}min_lon, 180.0D)"
    return (
        pairs.withColumns({
            "_lat_gap": F.expr(f"greatest({b}min_lat - {a}max_lat, {a}min_lat - {b}max_lat, 0.0D)"),
            "_lat_span": F.expr(f"greatest({a}max_lat, {b}max_lat) - least({a}min_lat, {b}min_lat)"),
            "_lon_gap": F.expr(lon_gap)})
        .withColumns({
            "lower_km": F.expr(f"{_arc_km('_lat_gap / 2', '_lon_gap / 2', far(a), far(b))} * {_d(1 - _SLACK)}"),
            "upper_km": F.expr(f"{_arc_km('_lat_span / 2', f'({lon_span}) / 2', near(a), near(b))}"
                               f" * {_d(1 + _SLACK)}")})
        .drop("_lat_gap", "_lat_span", "_lon_gap")
    )
