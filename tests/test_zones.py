"""Results must not depend on the time zone of the Python process, nor on a batch being tried twice."""

import json
import os
import subprocess
import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalog.fixtures import fixed_flag
from surveil import schemas
from surveil.sources.store import Store
from surveil.streaming import jobs

ROOT = Path(__file__).resolve().parent.parent
SCRIPT = """
import hashlib, json, sys
from datetime import datetime
from pyspark.sql import functions as F
import __spark_entry__ as driver
from catalog.fixtures import fixed_flag
from surveil.session import build_session
from surveil.sources.store import Store
from surveil.streaming import jobs

root = sys.argv[1]
spark = build_session("zones", "local[2]", **{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false"})
store = Store(spark, root + "/store-" + sys.argv[2])
score = lambda rows: rows.withColumn("anomaly_score", F.lit(0.0)).withColumn("predicted_anomaly", fixed_flag())
jobs.run(spark, store, root + "/vitals", root + "/reports", score, "once")
jobs.run(spark, store, root + "/vitals", root + "/more", score, "once") if len(sys.argv) > 3 else None
text = lambda frame, *names: sorted(map(str, frame.select(*[F.col(n).cast("string") for n in names]).collect()))
out = {
    "reports": text(store.read("geo_events"), "event_id", "event_time"),
    "range": text(store.read_range("geo_events", datetime(2024, 1, 2), datetime(2024, 1, 2, 1)), "event_id"),
    "risk": text(store.read("region_risk"), "region", "window_end", "risk_score"),
    "clusters": text(store.read("clusters"), "cluster_id", "event_count"),
}
for name in ("range_scan_vitals", "filter_reports"):
    frame = driver.queries()[name](spark, "/root/testdata/sf0.001")
    out[name] = text(frame, "event_id", "event_time")
print("RESULT" + json.dumps(out))
"""


def stamp(minutes):
    return (datetime(2024, 1, 2) + timedelta(minutes=minutes)).isoformat(timespec="milliseconds") + "+00:00"


def report(i, minutes):
    return {"event_id": f"G-{i}", "event_time": stamp(minutes), "region_id": "R1", "region_name": "x", "latitude": 12.97, "longitude": 77.59,
            "symptom_category": "fever", "severity": 1, "case_count": 2, "created_at": stamp(minutes)}


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("zones")
    for name in ("vitals", "reports"):
        (root / name).mkdir()
    rows = [report(i, minutes) for i, minutes in enumerate([30] * 10 + [-30] * 6 + [23 * 60 + 30] * 8)]
    (root / "reports" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    (root / "reports" / "b.json").write_text("\n".join(map(json.dumps, rows)))  # all of it again
    return root


def test_zones_agree(files):
    found = []
    for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
        run = subprocess.run([sys.executable, "-c", SCRIPT, str(files), zone.replace("/", "-")], cwd=ROOT, capture_output=True, text=True, timeout=900,
                             env=os.environ | {"TZ": zone, "PYTHONPATH": str(ROOT)})
        assert "RESULT" in run.stdout, run.stderr[-3000:]
        found.append(json.loads(run.stdout.split("RESULT")[1]))
    assert found[0] == found[1] == found[2]
    assert len(found[0]["reports"]) == 24 and len(found[0]["range"]) == 10
    assert len(found[0]["clusters"]) == 3 and len(found[0]["risk"]) == 18


def score(rows):
    return rows.withColumn("anomaly_score", F.lit(0.0)).withColumn("predicted_anomaly", fixed_flag())


def contents(store):
    return {name: sorted(map(str, store.read(name).drop("processed_at", "calculated_at", "recorded_at", "latency_seconds").collect()))
            for name in ("geo_events", "quarantine", "late_reports", "batch_metrics", "clusters", "region_risk", "assignments")}


def test_a_batch_tried_again_changes_nothing(spark, tmp_path, monkeypatch):
    rows = [report(i, 30) for i in range(8)] + [report(20, 30) | {"case_count": 0}]
    late = [report(30 + i, -600) for i in range(3)] + [report(40, 60)]
    frames = [spark.read.schema(schemas.REPORT).json(spark.sparkContext.parallelize(list(map(json.dumps, part)))) for part in (rows, late)]
    once, twice = (Store(spark, str(tmp_path / name)) for name in ("once", "twice"))
    for store in (once, twice):
        store.create()
        handle = jobs.reports_handler(store, lateness=timedelta(hours=3))
        for number, frame in enumerate(frames):
            if store is twice:
                def broken(*_):
                    raise OSError("disk gone")
                with monkeypatch.context() as m:
                    m.setattr(jobs, "update_windows", broken)
                    with pytest.raises(OSError):
                        handle(frame, number)
            handle(frame, number)
    assert contents(once) == contents(twice)
    assert len(contents(once)["late_reports"]) == 3 and len(contents(once)["quarantine"]) == 1


def test_a_large_batch_is_refused_before_anything_is_written(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create()
    frame = spark.read.schema(schemas.REPORT).json(spark.sparkContext.parallelize([json.dumps(report(i, 5)) for i in range(5)]))
    with pytest.raises(jobs.BatchTooLarge):
        jobs.reports_handler(store, limit=4)(frame, 0)
    assert store.table_names() == set()
    jobs.reports_handler(store, limit=5)(frame, 0)
    assert store.read("geo_events").count() == 5


def test_late_readings_change_the_risk(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create()
    part = spark.read.schema(schemas.REPORT).json(spark.sparkContext.parallelize([json.dumps(report(i, 30)) for i in range(8)]))
    jobs.reports_handler(store)(part, 0)
    before = store.read("region_risk").filter("region = 'R1'").first()["anomaly_rate"]
    reading = {"event_id": "V-1", "patient_id": "P", "region_id": "R1", "event_time": stamp(31), "heart_rate": 80, "systolic_bp": 120, "diastolic_bp": 80,
               "oxygen_saturation": 97.0, "body_temperature": 37.0, "respiratory_rate": 16, "latitude": 12.9, "longitude": 77.5, "created_at": stamp(31)}
    frame = spark.read.schema(schemas.READING).json(spark.sparkContext.parallelize([json.dumps(reading)]))
    flag = lambda rows: rows.withColumn("anomaly_score", F.lit(1.0)).withColumn("predicted_anomaly", F.lit(True))
    jobs.vitals_handler(store, flag)(frame, 0)
    assert before == 0.0 and store.read("region_risk").filter("region = 'R1'").first()["anomaly_rate"] == 1.0


def test_broken_lines_keep_their_text(spark, tmp_path):
    (tmp_path / "v").mkdir()
    (tmp_path / "r").mkdir()
    (tmp_path / "v" / "a.json").write_text("{ broken line\n")
    store = Store(spark, str(tmp_path / "store"))
    jobs.run(spark, store, str(tmp_path / "v"), str(tmp_path / "r"), score, "once")
    assert [r["record"] for r in store.read("quarantine").collect()] == ["{ broken line"]


def test_forecasts_are_published(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create()
    rows = [report(i, 15 * i) for i in range(40)]
    frame = spark.read.schema(schemas.REPORT).json(spark.sparkContext.parallelize(list(map(json.dumps, rows))))
    jobs.reports_handler(store)(frame, 0)
    jobs.publish_forecasts(store)
    kept = store.read("forecasts")
    assert kept.count() > 0 and kept.filter("generated_at IS NULL OR kind IS NULL").isEmpty()
