"""Rolling counts, verdicts on arrival and exact neighbour counts against brute force."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from surveil.operators import neighbours, rolling
from test_dbscan import all_cases, crowded, scattered

START = datetime(2024, 1, 1)


def near(points: pd.DataFrame, eps: float) -> np.ndarray:
    lat, lon = np.radians(points["latitude"].to_numpy()), np.radians(points["longitude"].to_numpy())
    chord = np.sin((lat[:, None] - lat) / 2) ** 2 + np.cos(lat[:, None]) * np.cos(lat) * np.sin((lon[:, None] - lon) / 2) ** 2
    return 2 * 6371.0 * np.arcsin(np.sqrt(np.minimum(chord, 1))) <= eps


def verdicts(points: pd.DataFrame, eps=0.5, m=5, minutes=60) -> dict:
    close = near(points, eps)
    times = points["event_time"].to_numpy()
    out = {}
    for at, event in enumerate(points["event_id"]):
        alive = (times <= times[at]) & (times > times[at] - np.timedelta64(minutes, "m"))
        core = (close & alive).sum(axis=1) >= m
        out[event] = bool((close[at] & alive & core).any())
    return out


def arrivals(seed, tick):
    """Blobs, copies of one position and scattered points over five hours, times on multiples of ``tick`` minutes."""
    random = np.random.default_rng(seed)
    rows = crowded(0, 6) + scattered(seed, 0, 150, 0.02) + [(0, 12.97, 77.59)] * 60
    rows += scattered(1, 0, 80, 0.02, lat=0.0, lon=180.0)
    table = pd.DataFrame(rows, columns=["w", "latitude", "longitude"]).drop(columns="w")
    table["event_id"] = [f"E-{i:05d}" for i in random.permutation(len(table))]
    table["event_time"] = [START + timedelta(minutes=tick * int(i)) for i in random.integers(0, 300 // tick, len(table))]
    return table


@pytest.mark.parametrize("tick", [5, 1, 60])
def test_verdicts_match_clustering_every_window(spark, tick):
    table = arrivals(tick, tick)
    got = {r["event_id"]: r["in_cluster"] for r in rolling.verdicts_on_arrival(spark.createDataFrame(table)).collect()}
    want = verdicts(table)
    assert got == want and {True, False} == set(want.values())


def test_hot_places_are_salted(spark, monkeypatch):
    monkeypatch.setattr(rolling, "ROWS_PER_SALT", 3)
    monkeypatch.setattr("surveil.operators.skew.ROWS_PER_SALT", 3)
    table = arrivals(3, 30)
    got = {r["event_id"]: r["in_cluster"] for r in rolling.verdicts_on_arrival(spark.createDataFrame(table)).collect()}
    assert got == verdicts(table)


def test_no_event_is_repeated_per_window(spark):
    """The largest join of the replay is that of a probe with the points of a cell and time, never events times windows."""
    table = spark.createDataFrame(arrivals(1, 5))
    assert rolling.verdicts_on_arrival(table).count() == table.count()
    assert rolling.verdicts_on_arrival(table.limit(0)).collect() == []


def test_rolling_counts_are_open_left(spark):
    rows = spark.createDataFrame([("a", START, 2), ("a", START + timedelta(minutes=60), 3), ("a", START + timedelta(minutes=90), 1), ("b", START, 1)],
                                 "cell string, event_time timestamp, n bigint")
    got = {(r["cell"], r["since"]): (r["until"], r["n"]) for r in rolling.rolling_counts(rows, ["cell"], 60).collect()}
    t = lambda m: START + timedelta(minutes=m)
    assert got == {("a", t(0)): (t(60), 2), ("a", t(60)): (t(90), 3), ("a", t(90)): (t(120), 4), ("a", t(120)): (t(150), 1), ("b", t(0)): (t(60), 1)}


def degrees(table):
    want = {}
    for end, part in table.groupby("window_end"):
        want |= {(end.to_pydatetime(), e): int(n) for e, n in zip(part["event_id"], near(part, 0.5).sum(axis=1))}
    return want


@pytest.mark.parametrize("limit", [1024, 1])
def test_degrees_are_exact(spark, monkeypatch, limit):
    monkeypatch.setattr(neighbours, "PAIRWISE_LIMIT", limit)
    table = all_cases(1 if limit > 1 else 4)
    got = {(r["window_end"], r["event_id"]): r["degree"] for r in neighbours.neighbour_degree(spark.createDataFrame(table)).collect()}
    want = degrees(table)
    assert got == want and max(want.values()) > 20


def test_degrees_of_hot_positions(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS_PER_SALT", 20)
    rows = spark.createDataFrame(all_cases(4))
    assert {(r["window_end"], r["event_id"]): r["degree"] for r in neighbours.neighbour_degree(rows).collect()} == degrees(all_cases(4))
    assert neighbours.neighbour_degree(rows.limit(0)).collect() == []
    with pytest.raises(ValueError, match="is_corrupt"):
        neighbours.neighbour_degree(rows.withColumn("is_corrupt", F.lit(True)))
