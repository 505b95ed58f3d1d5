"""Grid clustering against brute force, also where one place holds most of the points."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from surveil.operators import components, dbscan

START = datetime(2024, 1, 1)


def brute_force(points: pd.DataFrame, eps: float, m: int) -> dict:
    """{event_id: (is_core, cluster_no)} by the definition, in (event_time, event_id) order."""
    points = points.sort_values(["event_time", "event_id"]).reset_index(drop=True)
    lat, lon = np.radians(points["latitude"].to_numpy()), np.radians(points["longitude"].to_numpy())
    chord = (np.sin((lat[:, None] - lat) / 2) ** 2
             + np.cos(lat[:, None]) * np.cos(lat) * np.sin((lon[:, None] - lon) / 2) ** 2)
    near = 2 * 6371.0 * np.arcsin(np.sqrt(np.minimum(chord, 1))) <= eps
    core = near.sum(axis=1) >= m
    number = np.full(len(points), -1)
    found = 0
    for start in range(len(points)):
        if not core[start] or number[start] != -1:
            continue
        todo = [start]
        number[start] = found
        while todo:
            at = todo.pop()
            for other in np.flatnonzero(near[at] & core & (number == -1)):
                number[other] = found
                todo.append(other)
        found += 1
    for at in np.flatnonzero(~core):
        around = number[near[at] & core]
        if len(around):
            number[at] = around.min()
    return {e: (bool(c), int(n)) for e, c, n in zip(points["event_id"], core, number)}


def frame(rows) -> pd.DataFrame:
    table = pd.DataFrame(rows, columns=["window", "latitude", "longitude"])
    table["event_id"] = [f"E-{i:06d}" for i in np.random.default_rng(9).permutation(len(table))]
    table["event_time"] = [START + timedelta(minutes=int(i)) for i in np.random.default_rng(8).integers(0, 60, len(table))]
    table["window_end"] = [START + timedelta(hours=int(w)) for w in table["window"]]
    return table.drop(columns="window")


def scattered(seed, window, n, spread, lat=12.97, lon=77.59):
    random = np.random.default_rng(seed)
    return [(window, lat + a, ((lon + b + 180) % 360) - 180) for a, b in random.uniform(-spread, spread, (n, 2))]


def crowded(window, scale=1):
    """Blobs of many points, many copies of one position, and gaps close to eps."""
    random = np.random.default_rng(5)
    rows = []
    for lat, lon in ((12.97, 77.59), (12.97 + 0.0098, 77.59), (12.97, 77.59 + 0.0109), (12.93, 77.50)):
        rows += [(window, lat + a, lon + b) for a, b in random.uniform(-0.0022, 0.0022, (260 // scale, 2))]
    rows += [(window, 12.95, 77.60)] * (300 // scale) + [(window, 12.95 + 0.6 / 111.19, 77.60)] * (300 // scale)
    rows += [(window, 12.90, 77.60)] * (300 // scale) + [(window, 12.90 + 0.4 / 111.19, 77.60)] * (300 // scale)
    return rows + scattered(3, window, 200, 0.04)


KM = 1 / 111.19
# a point between two groups that is near the first point of each only
BETWEEN = [(10 - i * 0.05 * KM, 20.0) for i in range(6)] + [(10 + (0.96 + i * 0.05) * KM, 20.0) for i in range(6)] + [
    (10 + 0.48 * KM, 20.0)]


def all_cases(scale=1) -> pd.DataFrame:
    """Every window is a case of its own."""
    far_north = [(7, 89.995 + 0.2 * abs(a - 12.97), b * 9e3 % 360 - 180) for _, a, b in scattered(2, 7, 120, 0.02)]
    return frame(
        scattered(0, 0, 150, 0.03) + scattered(1, 1, 150, 0.02) + scattered(2, 2, 300, 0.05)
        + [(3, *place) for place in BETWEEN]
        + [(4, 12.97 + i * 1e-4, 77.59) for i in range(8)] + [(4, 13.2 + i, 77.9) for i in range(3)]
        + [(5, 10 + 0.05 * i, 77.0) for i in range(10)]
        + scattered(1, 6, 120, 0.02, lat=0.0, lon=180.0) + far_north + crowded(8, scale))


def expected(table, eps=0.5, m=5) -> dict:
    want = {}
    for end, part in table.groupby("window_end"):
        want |= {(end.to_pydatetime(), e): v for e, v in brute_force(part, eps, m).items()}
    return want


def check(spark, table):
    got = {(r["window_end"], r["event_id"]): (r["is_core"], r["cluster_no"])
           for r in dbscan.find_clusters(spark.createDataFrame(table)).collect()}
    want = expected(table)
    assert {k: (got.get(k), want[k]) for k in want if got.get(k) != want[k]} == {} and len(got) == len(want)


def test_brute_force_knows_the_small_cases():
    want = expected(all_cases(4))
    per_window = {hour: [v for (end, _), v in want.items() if end == START + timedelta(hours=hour)] for hour in range(9)}
    assert [n for core, n in per_window[3] if not core] == [0]        # the border takes the first cluster
    assert sorted(n for _, n in per_window[3]) == [0] * 7 + [1] * 6
    assert sorted(n for _, n in per_window[4]) == [-1] * 3 + [0] * 8
    assert {n for _, n in per_window[5]} == {-1}
    assert all(any(core for core, _ in per_window[w]) for w in (0, 1, 6, 7, 8))


def test_all_cases(spark):
    check(spark, all_cases())


def test_hot_cells_are_salted(spark, monkeypatch):
    monkeypatch.setattr(dbscan, "ROWS_PER_SALT", 40)
    check(spark, all_cases(2))


def test_boxes_are_split_down_to_positions(spark, monkeypatch):
    monkeypatch.setattr(dbscan, "PAIRWISE_LIMIT", 1)
    check(spark, all_cases(4))


def test_membership_without_components(spark):
    table = all_cases()
    rows = spark.createDataFrame(table)
    want = expected(table)
    flags = {(r["window_end"], r["event_id"]): (r["is_core"], r["in_cluster"]) for r in dbscan.core_and_members(rows).collect()}
    assert flags == {key: (core, number >= 0) for key, (core, number) in want.items()}


def test_large_graphs_are_contracted(spark):
    random = np.random.default_rng(4)
    chain = [(0, i, i + 1) for i in range(0, 300)]
    sparse = [(1, int(a), int(b)) for a, b in random.integers(0, 200, (120, 2))]
    edges = spark.createDataFrame(chain + sparse + [(0, 900, 900)], "g int, a bigint, b bigint")
    got = {tuple(r) for r in components.connected_components(edges, "g").collect()}
    root = {(g, n): n for g, a, b in [*chain, *sparse, (0, 900, 900)] for n in (a, b)}
    changed = True
    while changed:
        changed = False
        for g, a, b in chain + sparse:
            low = min(root[g, a], root[g, b])
            changed |= root[g, a] != low or root[g, b] != low
            root[g, a] = root[g, b] = low
    assert got == {(g, n, r) for (g, n), r in root.items()}


def test_empty_input_keeps_its_columns(spark):
    empty = dbscan.find_clusters(spark.createDataFrame(all_cases(4)).limit(0))
    assert empty.count() == 0 and {"cluster_no", "cluster_id", "in_cluster"} <= set(empty.columns)


def test_truth_columns_are_refused(spark):
    rows = spark.createDataFrame([("a", True, "x")], "event_id string, is_corrupt boolean, outbreak_id string")
    with pytest.raises(ValueError, match="is_corrupt, outbreak_id"):
        dbscan.find_clusters(rows)


def test_partitioning_and_order_do_not_matter(spark):
    table = frame(scattered(7, 0, 150, 0.02))

    def run(rows):
        return sorted((r["event_id"], r["cluster_no"]) for r in dbscan.find_clusters(rows).collect())
    shuffled = spark.createDataFrame(table.sample(frac=1, random_state=1))
    assert run(spark.createDataFrame(table).coalesce(1)) == run(shuffled.repartition(7))
