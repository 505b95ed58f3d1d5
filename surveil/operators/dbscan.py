"""Exact DBSCAN (haversine) over many time windows at once, without listing point pairs.

Places where no cluster is possible are set aside by counting coarse blocks. The remaining
points of a window are put on a grid whose cells are smaller than ``eps`` across. A cell with
``min_samples`` points or more is *dense*: all its points are core, known from its count alone.
Only points of *sparse* cells (fewer than ``min_samples`` points each) need neighbour counts.
They look at the dense cells around them by bounding box first, and point by point only where
the box does not decide. So the work grows with the points, not with their pairs, however
many fall into one place.

Clusters are components of the cell graph: core points of a cell belong together, and two
cells are linked when some core point of one is within ``eps`` of some core point of the other.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveil.constants import CLUSTER_EPS_KM, CLUSTER_MIN_SAMPLES
from surveil.functions import geo
from surveil.operators.components import connected_components
from surveil.operators.skew import ROWS_PER_SALT, hot_keys, salted_join
from surveil.operators.validate import without_labels
from surveil.session import stage

# Up to this many point pairs, two boxes are compared point by point; beyond, they are split and decided
# again. It moves work between two ways of the same exact decision and changes no result.
PAIRWISE_LIMIT = 256
SPLIT = 4              # otherwise each box is split into SPLIT x SPLIT parts
_KEY = ["window_end", "cell"]


def _box_columns(prefix: str = "") -> list:
    return [F.min("latitude").alias(f"{prefix}min_lat"), F.max("latitude").alias(f"{prefix}max_lat"),
            F.min("_lon").alias(f"{prefix}min_lon"), F.max("_lon").alias(f"{prefix}max_lon")]


def _hot(sizes: DataFrame, key: list[str]) -> tuple[int, DataFrame | None]:
    """Size of the largest key, and the hot keys if there are any."""
    largest = sizes.agg(F.max("n")).first()[0] or 0
    return largest, hot_keys(sizes, key, "n", ROWS_PER_SALT) if largest > ROWS_PER_SALT else None


def _renamed(frame: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    """All columns but ``keep`` get a prefix."""
    return frame.select(*[F.col(n) if n in keep else F.col(n).alias(prefix + n)
                          for n in frame.columns])


def _distance(a: str, b: str):
    return geo.haversine_km(f"{a}latitude", f"{a}longitude", f"{b}latitude", f"{b}longitude")


class _Grid:
    """Staged tables shared by the steps below."""

    def __init__(self, members: DataFrame, eps_km: float, min_samples: int, prune: bool = True):
        if min_samples < 1:
            raise ValueError("min_samples must be at least 1")
        self.eps, self.m, self.side = geo.check_eps(eps_km), min_samples, eps_km / 1.5
        points = geo.with_cell(members, self.side)
        if prune:
            points = self._marked(stage(geo.with_cell(points, eps_km, "block"), "members"))
            points = stage(points.drop("block"), "points")
            self.points = points.filter("_keep").drop("_keep")
            self.alone = points.filter("_keep IS NULL")
        else:
            self.points = stage(points, "points")
        self.cells = stage(
            self.points.groupBy(*_KEY).agg(F.count("*").alias("n"), *_box_columns()), "cells")
        self.largest, self.hot = _hot(self.cells, _KEY)
        self.near = stage(self._near_cells(), "near")

    def _marked(self, points: DataFrame) -> DataFrame:
        """Points with ``_keep`` where a cluster is possible at all.

        Blocks as wide as eps are counted first. A block whose surroundings hold fewer than
        ``min_samples`` points has no core point, and a point is noise when no block near its
        own can have one. That settles scattered points without looking at any of them.
        """
        key = ["window_end", "block"]
        blocks = stage(points.groupBy(*key).agg(F.count("*").alias("n"), *_box_columns()), "blocks")
        own = [F.max(F.expr(f"IF(_to = block, {name}, NULL)")).alias(name) for name in geo.BOX]
        around = geo.explode_near_cells(blocks, self.eps, self.eps, "_to").groupBy("window_end", "_to").agg(
            F.sum("n").alias("_around"), *own)
        with_core = around.filter(F.col("min_lat").isNotNull() & (F.col("_around") >= self.m)).drop("_to")
        keep = geo.explode_near_cells(with_core, self.eps, self.eps, "block").select(*key).distinct()
        keep = stage(keep.withColumn("_keep", F.lit(True)), "keep")
        return salted_join(points, keep, key, _hot(blocks, key)[1], "event_id", "left")

    def dense(self):
        return F.col("n") >= self.m

    def _near_cells(self) -> DataFrame:
        """Pairs (a, b) of occupied cells whose boxes come within eps of each other.

        Both directions for a sparse ``a``; dense-dense pairs once.
        """
        a = geo.explode_near_cells(_renamed(self.cells, "a_", ["window_end", *geo.BOX]),
                                   self.side, self.eps, "b_cell")
        a = a.withColumnsRenamed({name: f"a_{name}" for name in geo.BOX})
        b = _renamed(self.cells, "b_", ["window_end"])
        once = (F.col("a_n") < self.m) | (
            (F.col("b_n") >= self.m) & (F.col("a_cell") < F.col("b_cell")))
        pairs = a.join(b, ["window_end", "b_cell"]).filter("a_cell <> b_cell").filter(once)
        return geo.with_distance_bounds(pairs, "a_", "b_").filter(F.col("lower_km") <= self.eps)

    def sparse_points(self) -> DataFrame:
        """Points of sparse cells."""
        return self._cool(self.points).join(self.cells.filter(~self.dense()).select(*_KEY, "n"), _KEY)

    def _cool(self, points: DataFrame) -> DataFrame:
        """Points without those of hot dense cells, dropped before a shuffle by cell."""
        if self.hot is None:
            return points
        hot = self.cells.filter((F.col("n") > ROWS_PER_SALT) & self.dense()).select(*_KEY)
        return points.join(hot, _KEY, "left_anti")

    def neighbours(self, sparse: DataFrame) -> DataFrame:
        """(window_end, s, s_cell, cell, t, found): neighbours of each sparse point elsewhere.

        In a dense cell ``found`` counts them and ``t`` is NULL; in a sparse cell each
        neighbour ``t`` has its own row (fewer than ``min_samples`` per cell).
        """
        s = sparse.selectExpr("window_end", "cell AS a_cell", "event_id AS s", "latitude AS s_latitude",
                              "longitude AS s_longitude", "latitude AS s_min_lat", "latitude AS s_max_lat",
                              "_lon AS s_min_lon", "_lon AS s_max_lon")
        near = self.near.filter(F.col("a_n") < self.m).drop(
            "lower_km", "upper_km", *[f"a_{name}" for name in geo.BOX])
        probes = geo.with_distance_bounds(s.join(near, ["window_end", "a_cell"]), "s_", "b_").filter(
            F.col("lower_km") <= self.eps)
        inside = (F.col("b_n") >= self.m) & (F.col("upper_km") <= self.eps)
        whole = probes.filter(inside).select(
            "window_end", "s", F.col("a_cell").alias("s_cell"), F.col("b_cell").alias("cell"),
            F.lit(None).cast(self.points.schema["event_id"].dataType).alias("t"), F.col("b_n").alias("found"))
        open_probes = probes.filter(~inside).select(
            "window_end", F.col("b_cell").alias("cell"), "s", F.col("a_cell").alias("s_cell"),
            "s_latitude", "s_longitude", "b_n")
        points = self.points.select(*_KEY, F.col("event_id").alias("t"), "latitude", "longitude")
        close = salted_join(points, open_probes, _KEY, self.hot, "t").filter(
            _distance("s_", "") <= self.eps)
        # a neighbour in a dense cell is only counted, one in a sparse cell keeps its id
        named = F.when(F.col("b_n") < self.m, F.col("t"))
        counted = close.groupBy("window_end", "s", "s_cell", "cell", named.alias("t")).agg(
            F.count("*").alias("found"))
        return whole.unionByName(counted)

    def dense_links(self) -> DataFrame:
        """Pairs (window_end, a, b) of dense cells with points within eps of each other.

        Boxes decide first; small boxes are compared point by point, larger ones are split
        and decided again, so no cell pair is ever expanded in full.
        """
        open_pairs = self.near.filter((F.col("a_n") >= self.m) & (F.col("b_n") >= self.m)).select(
            "window_end", "a_cell", "b_cell", "a_n", "b_n", "lower_km", "upper_km",
            *[f"a_{n}" for n in geo.BOX], *[f"b_{n}" for n in geo.BOX],
            *[F.lit(0).cast("long").alias(n) for n in ("a_y", "a_x", "b_y", "b_x")])
        # copies of a position count once here; the hottest cells are never small at level 0
        points = self.points.select(*_KEY, "latitude", "longitude", "_lon").distinct()
        zero = F.lit(0).cast("long")
        placed = self._cool(points).withColumn("y", zero).withColumn("x", zero)
        links, level = None, 0
        while True:
            certain = open_pairs.filter(F.col("upper_km") <= self.eps).select("window_end", "a_cell", "b_cell")
            unsure = open_pairs.filter(F.col("upper_km") > self.eps)
            if level:
                unsure = unsure.join(certain.distinct(), ["window_end", "a_cell", "b_cell"], "left_anti")
            single = F.expr("a_min_lat = a_max_lat AND a_min_lon = a_max_lon"
                            " AND b_min_lat = b_max_lat AND b_min_lon = b_max_lon")
            small = F.col("a_n") * F.col("b_n") <= PAIRWISE_LIMIT
            found = certain.unionByName(self._touching(unsure.filter(small & ~single), placed)).unionByName(
                self._coinciding(unsure.filter(single)))
            links = found if links is None else links.unionByName(found)
            if level == 0 and self.largest ** 2 <= PAIRWISE_LIMIT:
                break
            rest = stage(unsure.filter(~small & ~single), f"open{level}")
            if rest.isEmpty():
                break
            links = stage(links.distinct(), f"links{level}")
            rest = stage(rest.join(links, ["window_end", "a_cell", "b_cell"], "left_anti"), f"rest{level}")
            level += 1
            placed = self._placed(points, rest, level)
            open_pairs = stage(self._split(rest, placed), f"split{level}")
        return links.distinct()

    def _placed(self, points: DataFrame, rest: DataFrame, level: int) -> DataFrame:
        """Points of the cells in open pairs, with the part (y, x) of the cell they fall in.

        A cell's box has ``SPLIT ** level`` parts along each side.
        """
        involved = rest.select("window_end", F.explode(F.array("a_cell", "b_cell")).alias("cell")).distinct()
        boxes = self.cells.select(*_KEY, *geo.BOX).join(involved, _KEY, "left_semi")
        parts = SPLIT ** level

        def part(value, low, high):
            width = F.col(high) - F.col(low)
            share = F.when(width > 0, (F.col(value) - F.col(low)) / width).otherwise(F.lit(0.0))
            return F.least(F.floor(share * parts), F.lit(parts - 1)).cast("long")

        return (salted_join(points, boxes, _KEY, self.hot, "latitude")
                .withColumn("y", part("latitude", "min_lat", "max_lat"))
                .withColumn("x", part("_lon", "min_lon", "max_lon")).drop(*geo.BOX))

    def _split(self, rest: DataFrame, placed: DataFrame) -> DataFrame:
        """Open pairs at the next level: parts of ``a`` against parts of ``b``."""
        parts = (placed.groupBy(*_KEY, "y", "x").agg(F.count("*").alias("n"), *_box_columns())
                 .withColumn("up_y", F.floor(F.col("y") / SPLIT)).withColumn("up_x", F.floor(F.col("x") / SPLIT)))
        pairs = rest.select("window_end", "a_cell", "b_cell",
                            *[F.col(n).alias(f"{n[0]}_up_{n[2]}") for n in ("a_y", "a_x", "b_y", "b_x")])
        a, b = (_renamed(parts, side, ["window_end"]) for side in ("a_", "b_"))
        pairs = (pairs.join(a, ["window_end", "a_cell", "a_up_y", "a_up_x"])
                 .join(b, ["window_end", "b_cell", "b_up_y", "b_up_x"])
                 .drop("a_up_y", "a_up_x", "b_up_y", "b_up_x"))
        return geo.with_distance_bounds(pairs, "a_", "b_").filter(F.col("lower_km") <= self.eps)

    def _touching(self, pairs: DataFrame, placed: DataFrame) -> DataFrame:
        """Pairs of small boxes with at least one point pair within eps."""
        pairs = pairs.select("window_end", "a_cell", "b_cell", "a_y", "a_x", "b_y", "b_x")
        a, b = (_renamed(placed.drop("_lon"), side, ["window_end"]) for side in ("a_", "b_"))
        return (pairs.join(a, ["window_end", "a_cell", "a_y", "a_x"])
                .join(b, ["window_end", "b_cell", "b_y", "b_x"])
                .filter(_distance("a_", "b_") <= self.eps)
                .select("window_end", "a_cell", "b_cell").distinct())

    def _coinciding(self, pairs: DataFrame) -> DataFrame:
        """Boxes that are one place each (copies of a position): compare the two places."""
        gap = geo.haversine_km("a_min_lat", "a_min_lon", "b_min_lat", "b_min_lon")
        return pairs.filter(gap <= self.eps).select("window_end", "a_cell", "b_cell")


def _core_sparse(grid: _Grid) -> tuple[DataFrame, DataFrame]:
    """Sparse points with ``is_core``, and their neighbours with ``t_core``."""
    sparse = stage(grid.sparse_points(), "sparse")
    links = stage(grid.neighbours(sparse), "neighbours")
    degree = links.groupBy("window_end", F.col("s").alias("event_id")).agg(F.sum("found").alias("_found"))
    sparse = stage(
        sparse.join(degree, ["window_end", "event_id"], "left")
        .withColumn("degree", F.col("n") + F.coalesce("_found", F.lit(0)))
        .withColumn("is_core", F.col("degree") >= grid.m).drop("_found"), "degrees")
    core = sparse.filter("is_core").select("window_end", F.col("event_id").alias("t"),
                                           F.lit(True).alias("_t_core"))
    links = links.join(core, ["window_end", "t"], "left").withColumn(
        "t_core", F.col("t").isNull() | F.col("_t_core").isNotNull()).drop("_t_core")
    return sparse, links


def _members(members: DataFrame) -> DataFrame:
    return without_labels(members)


def _dense_points(grid: _Grid, cells: DataFrame) -> DataFrame:
    """Points joined with a per-cell table of dense cells."""
    return salted_join(grid.points, cells, _KEY, grid.hot, "event_id")


def core_and_members(members: DataFrame, eps_km: float = CLUSTER_EPS_KM,
                     min_samples: int = CLUSTER_MIN_SAMPLES) -> DataFrame:
    """``members`` with ``is_core`` and ``in_cluster``; needs no components, so it never iterates."""
    columns = members.columns
    grid = _Grid(_members(members), eps_km, min_samples)
    sparse, links = _core_sparse(grid)
    touched = links.filter("t_core").select("window_end", F.col("s").alias("event_id")).distinct().withColumn(
        "_touched", F.lit(True))
    own = sparse.filter("is_core").select(*_KEY).distinct().withColumn("_own", F.lit(True))
    in_cluster = F.col("is_core") | F.col("_touched").isNotNull() | F.col("_own").isNotNull()
    few = (sparse.join(touched, ["window_end", "event_id"], "left").join(own, _KEY, "left")
           .select(*columns, "is_core", in_cluster.alias("in_cluster")))
    dense = _dense_points(grid, grid.cells.filter(grid.dense()).select(*_KEY))
    return few.unionByName(dense.select(
        *columns, F.lit(True).alias("is_core"), F.lit(True).alias("in_cluster"))).unionByName(
        grid.alone.select(*columns, F.lit(False).alias("is_core"), F.lit(False).alias("in_cluster")))


def _numbered(clusters: DataFrame) -> DataFrame:
    """(window_end, component, cluster_no): clusters of a window numbered from 0 by ``_first``.

    Clusters are counted per second of their first event; a window has few seconds, so the sums
    over them are small, and the clusters themselves are ranked second by second.
    """
    timed = stage(clusters.withColumn("_second", F.unix_seconds(F.col("_first.event_time").cast("timestamp"))), "clusters")
    seconds = timed.groupBy("window_end", "_second").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("window_end").orderBy("_second").rowsBetween(Window.unboundedPreceding, -1)
    seconds = seconds.select("window_end", "_second", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("window_end", "_second").orderBy("_first")
    return timed.withColumn("_place", F.row_number().over(within)).join(seconds, ["window_end", "_second"]).select(
        "window_end", "component", (F.col("_before") + F.col("_place") - 1).cast("int").alias("cluster_no"))


def find_clusters(members: DataFrame, eps_km: float = CLUSTER_EPS_KM,
                  min_samples: int = CLUSTER_MIN_SAMPLES) -> DataFrame:
    """``members`` with ``is_core``, ``in_cluster``, ``cluster_no`` (-1 = noise) and ``cluster_id``.

    ``members`` holds one row per (window_end, event_id) with event_time, latitude and
    longitude; other columns are carried through. Clusters of a window are numbered by their
    first core event in (event_time, event_id) order; a border event next to several
    clusters belongs to the lowest number.
    """
    columns = members.columns
    grid = _Grid(_members(members), eps_km, min_samples)
    sparse, links = _core_sparse(grid)
    core_s = sparse.filter("is_core").select("window_end", F.col("event_id").alias("s"))
    sparse_edges = links.filter("t_core").join(core_s, ["window_end", "s"], "left_semi").select(
        "window_end", F.col("s_cell").alias("a"), F.col("cell").alias("b"))
    dense_edges = grid.dense_links().select(
        "window_end", F.col("a_cell").alias("a"), F.col("b_cell").alias("b"))
    # every cell with a core point is a node; a loop keeps cells without links in the graph
    dense_cells = grid.cells.filter(grid.dense()).select(*_KEY)
    nodes = dense_cells.unionByName(sparse.filter("is_core").select(*_KEY).distinct())
    edges = stage(sparse_edges.unionByName(dense_edges).distinct().unionByName(
        nodes.select("window_end", F.col("cell").alias("a"), F.col("cell").alias("b"))), "edges")
    components = stage(connected_components(edges, "window_end").withColumnRenamed("node", "cell"), "components")

    position = F.struct("event_time", "event_id")
    first_dense = grid.points.groupBy(*_KEY).agg(F.min(position).alias("_first")).join(
        dense_cells, _KEY, "left_semi")
    first_sparse = sparse.filter("is_core").groupBy(*_KEY).agg(F.min(position).alias("_first"))
    clusters = components.join(first_dense.unionByName(first_sparse), _KEY).groupBy(
        "window_end", "component").agg(F.min("_first").alias("_first"))
    numbered = _numbered(clusters)
    labels = stage(components.join(numbered, ["window_end", "component"]).select(*_KEY, "cluster_no"), "labels")

    dense = _dense_points(grid, labels.join(dense_cells, _KEY, "left_semi")).withColumn(
        "is_core", F.lit(True))
    own = sparse.join(labels, _KEY, "left").select(
        "window_end", "event_id", F.when(F.col("cluster_no").isNotNull(), F.col("cluster_no")).alias("cluster_no"))
    around = links.filter("t_core").join(labels, _KEY).select(
        "window_end", F.col("s").alias("event_id"), "cluster_no")
    lowest = own.unionByName(around).groupBy("window_end", "event_id").agg(
        F.min("cluster_no").alias("cluster_no"))
    few = sparse.join(lowest, ["window_end", "event_id"])
    number = F.coalesce("cluster_no", F.lit(-1)).cast("int")
    label = F.concat(F.date_format("window_end", "yyyyMMdd'T'HHmm"), F.lit("-"), F.col("cluster_no"))
    alone = grid.alone.select(*columns, F.lit(False).alias("is_core"), F.lit(-1).alias("cluster_no"))
    return dense.select(*columns, "is_core", "cluster_no").unionByName(
        few.select(*columns, "is_core", "cluster_no")).unionByName(alone).select(
        *columns, "is_core", (number >= 0).alias("in_cluster"), number.alias("cluster_no"),
        F.when(number >= 0, label).alias("cluster_id"))
