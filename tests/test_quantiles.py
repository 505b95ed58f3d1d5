"""Exact quantiles against numpy, with outliers, ties and ranges that are refined."""

import numpy as np
import pytest

from surveil.operators import quantiles

WANTED = {"low": 0.0, "median": 0.5, "p95": 0.95, "p99": 0.999, "top": 1.0}


def groups():
    random = np.random.default_rng(5)
    return {"even": random.uniform(0, 1, 700).tolist(), "outlier": [*random.uniform(0, 1e-3, 500), 1e9], "ties": [3.0] * 400 + [4.0, 5.0],
            "powers": [10.0 ** i for i in range(-150, 150)], "one": [7.0], "two": [-1.0, 1.0], "negative": (-random.pareto(1.0, 300)).tolist()}


@pytest.mark.parametrize("ordered", [100_000, 5])
def test_equal_numpy(spark, monkeypatch, ordered):
    monkeypatch.setattr(quantiles, "ORDERED_VALUES", ordered)
    monkeypatch.setattr(quantiles, "PARTS", 8)
    data = groups()
    rows = [(name, float(v)) for name, values in data.items() for v in values] + [("even", None), ("none", None)]
    got = {r["g"]: r for r in quantiles.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", WANTED).collect()}
    assert set(got) == set(data)
    for name, values in data.items():
        for column, q in WANTED.items():
            assert got[name][column] == pytest.approx(np.quantile(values, q), rel=1e-12), (name, column)


def test_without_groups_and_empty(spark):
    frame = spark.createDataFrame([(i,) for i in range(101)], "v int")
    assert quantiles.exact_quantiles(frame, [], "v", {"m": 0.5}).first()["m"] == 50
    assert quantiles.exact_quantiles(frame.limit(0), [], "v", {"m": 0.5}).collect() == []
