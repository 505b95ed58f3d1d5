"""Neighbour counts: rows that are moved, batches of any size, and bounds anywhere on the sphere."""

from datetime import datetime

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from surveil.operators import neighbours
from surveil.session import stage
from test_dbscan import all_cases
from test_rolling import degrees


def brute(eps, at, near, n):
    out = []
    for group, lat, lon in zip(*at):
        mine = near[0] == group
        b_lat, b_lon = near[1][mine], near[2][mine]
        chord = np.sin(np.radians((b_lat - lat) / 2)) ** 2 + np.cos(np.radians(lat)) * np.cos(np.radians(b_lat)) * np.sin(np.radians((b_lon - lon) / 2)) ** 2
        out.append(n[mine][2 * 6371.0 * np.arcsin(np.sqrt(np.minimum(chord, 1))) <= eps].sum())
    return out


def moved(frame) -> int:
    """Rows that the exchanges of a plan have written, once it has run."""
    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind == "ReusedExchangeExec":
            return 0
        metric = node.metrics().get("shuffleRecordsWritten")
        below = node.children()
        return (metric.get().value() if metric.isDefined() else 0) + sum(walk(below.apply(i)) for i in range(below.size()))

    frame.collect()
    return walk(frame._jdf.queryExecution().executedPlan())


def test_pairs_of_positions_are_not_moved(spark, monkeypatch):
    """A crowded place: every event has some two thousand neighbours, all positions differ."""
    random = np.random.default_rng(1)
    size = 4000
    lat, lon = 12.97 + random.uniform(-0.004, 0.004, size), 77.59 + random.uniform(-0.004, 0.004, size)
    table = pd.DataFrame({"window_end": datetime(2024, 1, 1), "event_id": [f"E-{i}" for i in range(size)], "latitude": lat, "longitude": lon})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")        # as with tables too large for it
    total = []

    def counted_stage(frame, *rest):
        total.append(moved(frame))
        return stage(frame, *rest)

    monkeypatch.setattr(neighbours, "stage", counted_stage)
    try:
        found = neighbours.neighbour_degree(spark.createDataFrame(table))
        assert moved(found) + sum(total) <= 5 * size
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = found.toPandas().set_index("event_id")["degree"].loc[table["event_id"]]
    assert list(got) == list(degrees(table).values()) and got.mean() > 1500


@pytest.mark.parametrize("salt", [200_000, 50])
def test_degrees_of_blocks_counted_piece_by_piece(spark, monkeypatch, salt):
    monkeypatch.setattr(neighbours, "ROWS_PER_SALT", salt)
    monkeypatch.setattr(neighbours, "ROWS_HELD", 30)
    monkeypatch.setattr(neighbours, "PAIRWISE_LIMIT", 1)
    table = all_cases(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        rows = neighbours.neighbour_degree(spark.createDataFrame(table)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(rows) == len(table) and {(r["window_end"], r["event_id"]): r["degree"] for r in rows} == degrees(table)


def test_repeated_and_missing_ids_stay(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, 1), i, 10.0, 20.0) for i in ("a", "a", None)] + [(datetime(2024, 1, 1), "b", 10.0, None), (None, "c", 10.0, 20.0)],
                                 "window_end timestamp, event_id string, latitude double, longitude double")
    assert sorted((r["event_id"] or "", r["degree"]) for r in neighbours.neighbour_degree(rows).collect()) == [("", 3), ("a", 3), ("a", 3)]


@pytest.mark.parametrize("seed", range(40))
def test_batches_and_rows_held_do_not_matter(seed):
    random = np.random.default_rng(seed)
    names = ["window_end", "block", "part", "event_id", "latitude", "longitude", "n"]
    rows, want = [], {}
    for group in range(int(random.integers(1, 6))):
        part = int(random.integers(-1, 2))
        place = lambda: (12.97 + random.integers(0, 9) * 1e-3, 77.6 + random.integers(0, 9) * 1e-3)
        events = [(group, 7, part, f"{group}-{i}", *place(), None) for i in range(int(random.integers(0, 40)))]
        spots = [(group, 7, part, None, *place(), int(random.integers(1, 4))) for _ in range(int(random.integers(0, 40)))]
        rows += events + spots
        counted = spots + [(*e[:6], 1) for e in events if part < 0]
        at, near = ([np.array(x, dtype=float) for x in zip(*[(group, r[4], r[5]) for r in some])] or [np.empty(0)] * 3 for some in (events, counted))
        want |= dict(zip([e[3] for e in events], brute(0.5, at, near, np.array([r[6] for r in counted]))))
    schema = pa.schema(list(zip(names, [pa.timestamp("us"), pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.int64()])))
    batches = pa.Table.from_pylist([dict(zip(names, r)) for r in rows], schema=schema).to_batches(max_chunksize=int(random.integers(1, 12)))
    got = [r for batch in neighbours._degrees(batches, 0.5, int(random.choice([1, 1024])), int(random.integers(1, 60))) for r in batch.to_pylist()]
    assert len(got) == len(want) and {r["event_id"]: r["degree"] for r in got} == want


@pytest.mark.parametrize("kind", ["sphere", "middle", "poles", "date line", "lattice"])
def test_counts_match_brute_force_anywhere(kind):
    random = np.random.default_rng(7)
    for trial in range(60):
        eps = min(10 ** random.uniform(-4, 3.8), 6371.0)
        degree, groups = np.degrees(eps / 6371), int(random.integers(1, 4))

        def places(size):
            a, b = random.uniform(-4, 4, (2, size)) * degree
            if kind == "sphere":
                return random.uniform(-90, 90, size), random.uniform(-180, 180, size)
            if kind == "poles":
                return np.clip(random.choice([-90, 90]) + a, -90, 90), random.uniform(-180, 180, size)
            if kind == "date line":
                lon = (180 + b + 180) % 360 - 180
                return np.clip(a, -90, 90), np.where(random.random(size) < 0.1, random.choice([-180.0, 180.0], size), lon)
            step = 1 if kind == "middle" else degree / 4
            return np.clip(50 + (a if kind == "middle" else np.round(a / step) * step), -90, 90), np.clip(10 + (b if kind == "middle" else np.round(b / step) * step), -180, 180)

        at, near = ((np.sort(random.integers(0, groups + k, size)), *places(size)) for k, size in ((0, 150), (1, int(random.integers(1, 500)))))
        n = random.integers(1, 4, len(near[0])) if trial % 2 else np.ones(len(near[0]), dtype=np.int64)
        want = brute(eps, at, near, n)
        for pairwise in (1, 10 ** 9):
            assert list(neighbours.count_near(eps, pairwise, at, near, n)) == want
