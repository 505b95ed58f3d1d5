"""Windows at any time, and the evaluation job from files to the table."""

from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from catalog.fixtures import Feeds
from surveil import schemas
from surveil.operators import intervals
from surveil.sources import files
from surveil.sources.store import Store
from surveil.streaming import jobs

START = datetime(2024, 1, 1)


def test_members_at_any_end(spark, monkeypatch):
    random = np.random.default_rng(1)
    times = [START + timedelta(seconds=int(s)) for s in random.integers(0, 40_000, 400)] + [START + timedelta(minutes=30)] * 50
    ends = [START + timedelta(seconds=int(s)) for s in random.integers(0, 50_000, 60)] + [START + timedelta(minutes=30), START + timedelta(minutes=75)] * 2 + [START + timedelta(days=9)]
    rows = spark.createDataFrame([(f"E{i}", t) for i, t in enumerate(times)] + [("null", None)], "event_id string, event_time timestamp")
    given = spark.createDataFrame([(e,) for e in [*ends, None]], "window_end timestamp")
    want = sorted((e, f"E{i}") for e in set(ends) for i, t in enumerate(times) if e - timedelta(minutes=45) < t <= e)
    for limit in (200_000, 20):
        monkeypatch.setattr(intervals, "ROWS_PER_SALT", limit)
        got = intervals.members_at(rows, given, 45).select("window_end", "event_id").collect()
        assert sorted(map(tuple, got)) == want
    assert intervals.members_at(rows.limit(0), given).collect() == []


def test_evaluation_is_published(spark, tmp_path):
    feeds = Feeds(spark, "/root/testdata/sf0.001")
    half = F.lit(datetime(2024, 1, 16))
    for name, frame in (("train", feeds.raw_readings.filter(F.col("created_at") < half)), ("held", feeds.raw_readings.filter(F.col("created_at") >= half)), ("reports", feeds.raw_reports)):
        files.write_json_lines(frame, str(tmp_path / name))
    for name, frame in (("labels", feeds.reading_labels), ("report_labels", feeds.report_labels)):
        files.write_csv(frame, str(tmp_path / name))
    read = lambda name, schema: files.read_json_lines(spark, str(tmp_path / name), schema)
    store = Store(spark, str(tmp_path / "store"))
    store.create()
    jobs.publish_evaluation(store, read("train", schemas.READING), read("held", schemas.READING), files.read_csv(spark, str(tmp_path / "labels"), schemas.READING_LABEL),
                            read("reports", schemas.REPORT), files.read_csv(spark, str(tmp_path / "report_labels"), schemas.REPORT_LABEL), str(tmp_path / "model"), trees=20)
    rows = {r["detector"]: r for r in store.read("evaluation").collect()}
    assert set(rows) == {"forest", "dbscan"}
    assert rows["forest"]["items"] == read("held", schemas.READING).transform(jobs.validate.valid_readings).select("event_id").distinct().count()
    assert all(r["true_positives"] + r["false_positives"] + r["false_negatives"] + r["true_negatives"] == r["items"] for r in rows.values())
