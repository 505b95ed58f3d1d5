"""Both feeds end to end from files: bad lines, replays, late reports, restarts."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from catalog.fixtures import Feeds, fixed_flag
from surveil import schemas
from surveil.operators.clusters import cluster_summary, window_members
from surveil.operators.dbscan import find_clusters
from surveil.plans.risk import REPORT_COLUMNS, region_risk
from surveil.sources.files import stream_json
from surveil.sources.store import Store
from surveil.streaming import jobs

FROM, TO = datetime(2024, 1, 3), datetime(2024, 1, 3, 12)


def score(rows):
    return rows.withColumn("anomaly_score", F.lit(0.0)).withColumn("predicted_anomaly", fixed_flag())


def lines(frame, names):
    """The rows of half a day as JSON lines, hour by hour, without the second copies."""
    keep = frame.filter((F.col("event_time") > F.lit(FROM)) & (F.col("event_time") <= F.lit(TO)))
    by_hour = {}
    for row in keep.groupBy("event_id").agg(F.min(F.struct("created_at", *[n for n in names if n != "created_at"])).alias("r")).select("r.*").toPandas().to_dict("records"):
        item = {}
        for name in names:
            value = row[name]
            if hasattr(value, "isoformat"):
                value = value.isoformat(timespec="milliseconds") + "+00:00"
            elif value is None or value != value:
                value = None
            elif name in INTS:
                value = int(value)
            item[name] = value
        by_hour.setdefault(item["event_time"][:13], []).append(json.dumps(item))
    return [by_hour[hour] for hour in sorted(by_hour)]


INTS = {"heart_rate", "systolic_bp", "diastolic_bp", "respiratory_rate", "severity", "case_count"}


def valid(item):
    """The rules of a reading, on one record."""
    from surveil.constants import READING_REQUIRED, VITAL_RANGES
    return all(item.get(n) is not None for n in READING_REQUIRED) and all(a <= item[n] <= b for n, (a, b) in VITAL_RANGES.items()) and (
        item["systolic_bp"] > item["diastolic_bp"])


@pytest.fixture(scope="module")
def feed_files(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("feeds")
    feeds = Feeds(spark, "/root/testdata/sf0.01")
    written = {}
    for name, frame, schema in (("vitals", feeds.raw_readings, schemas.READING), ("reports", feeds.raw_reports, schemas.REPORT)):
        folder = root / name
        folder.mkdir()
        written[name] = lines(frame, schema.names)
        for number, hour in enumerate(written[name]):
            (folder / f"{number:03d}.json").write_text("\n".join(hour) + "\n")
    first = json.loads(written["vitals"][0][0])
    (root / "vitals" / "900.json").write_text("{ broken\n" + json.dumps(first | {"event_id": "V-float", "heart_rate": 72.5}) + "\n")
    (root / "vitals" / "901.json").write_text((root / "vitals" / "000.json").read_text())      # replay
    (root / "vitals" / "902.tmp").write_text(json.dumps(first | {"event_id": "V-tmp"}) + "\n")  # not published yet
    return root, written


@pytest.fixture(scope="module")
def finished(spark, feed_files, tmp_path_factory):
    root, _ = feed_files
    store = Store(spark, str(tmp_path_factory.mktemp("run") / "store"))
    jobs.run(spark, store, str(root / "vitals"), str(root / "reports"), score, "once")
    return store


def test_stored_rows_equal_batch_validation(spark, finished, feed_files):
    feeds = Feeds(spark, "/root/testdata/sf0.01")
    span = (F.col("event_time") > F.lit(FROM)) & (F.col("event_time") <= F.lit(TO))
    for table, batch in (("vitals_results", feeds.readings), ("geo_events", feeds.reports)):
        want = {r[0] for r in batch.filter(span).select("event_id").collect()}
        got = [r[0] for r in finished.read(table).select("event_id").collect()]
        assert sorted(got) == sorted(want)


def test_counters_and_quarantine(spark, finished, feed_files):
    _, written = feed_files
    total = sum(map(len, written["vitals"]))
    rows = finished.read("batch_metrics").groupBy("feed").agg(
        F.sum("rows_read").alias("r"), F.sum("rows_rejected").alias("j"), F.sum("rows_new").alias("n"), F.sum("rows_flagged").alias("f"))
    metrics = {r["feed"]: r for r in rows.collect()}
    stored = finished.read("vitals_results").count()
    rejected_again = metrics["vitals"]["j"] - 2 - sum(1 for hour in written["vitals"] for x in hour if not valid(json.loads(x)))
    assert metrics["vitals"]["r"] == total + 2 + rejected_again     # broken, float; valid replays were dropped in the stream
    progress = {r["feed"]: r for r in finished.read("stream_progress").groupBy("feed").agg(
        F.sum("rows_read").alias("r"), F.sum("replays_dropped").alias("d"), F.max("batch_ms").alias("ms"), F.max("state_rows").alias("s")).collect()}
    assert progress["vitals"]["r"] == total + 2 + len(written["vitals"][0])
    assert progress["vitals"]["d"] == len(written["vitals"][0]) - rejected_again > 0
    assert min(progress[f]["ms"] for f in progress) > 0 and progress["vitals"]["s"] >= stored
    assert metrics["vitals"]["n"] == stored
    bad = finished.read("quarantine").filter("feed = 'vitals'")
    assert bad.count() == metrics["vitals"]["j"] and bad.filter("reject_reason = 'missing_event_id'").count() == 1
    assert metrics["vitals"]["f"] >= finished.read("vitals_results").filter("predicted_anomaly").count()
    assert metrics["reports"]["f"] is None


def test_stream_results_equal_batch_results(spark, finished):
    reports, readings = finished.read("geo_events"), finished.read("vitals_results")
    labelled = find_clusters(window_members(reports.select(*REPORT_COLUMNS)))
    want = {(r["cluster_id"], r["event_count"], r["total_cases"]) for r in cluster_summary(labelled).collect()}
    assert {(r["cluster_id"], r["event_count"], r["total_cases"]) for r in finished.read("clusters").collect()} == want and want

    def rows(frame):
        return sorted(tuple(r) for r in frame.select("region", "window_end", "anomaly_rate", "clustered_cases", "risk_score", "risk_level").collect())
    assert rows(finished.read("region_risk")) == rows(region_risk(readings, reports))
    assert finished.geo_events().filter("in_cluster").count() == labelled.filter("in_cluster").count()


def test_restart_reads_nothing_twice_and_takes_new_files(spark, finished, feed_files):
    root, written = feed_files
    before = finished.read("batch_metrics").count()
    first = json.loads(written["reports"][-1][0])
    (root / "reports" / "910.json").write_text(json.dumps(first | {"event_id": "G-new"}) + "\n")
    jobs.run(spark, finished, str(root / "vitals"), str(root / "reports"), score, "once")
    assert finished.read("batch_metrics").count() == before + 1
    assert finished.read("geo_events").filter("event_id = 'G-new'").count() == 1


def test_late_reports(spark, tmp_path, feed_files):
    _, written = feed_files
    store = Store(spark, str(tmp_path / "store"))
    store.create()
    handle = jobs.reports_handler(store, lateness=timedelta(hours=3))
    frames = [spark.read.schema(schemas.REPORT).json(spark.sparkContext.parallelize(part)) for part in (
        written["reports"][-1], written["reports"][-3][:3], written["reports"][0][:3])]
    for number, frame in enumerate(frames):
        handle(frame, number)
    handle(frames[0].limit(0), 9)                                  # an empty batch does nothing
    assert store.read("geo_events").count() == sum(r["rows_new"] for r in store.read("batch_metrics").collect())
    assert store.read("batch_metrics").count() == 3
    assert store.read("late_reports").count() == store.read("geo_events").filter("event_time <= '2024-01-03 01:00:00'").count() > 0
    hours = {r[0].hour for r in store.read("region_risk").select("window_end").distinct().collect()}
    assert 1 not in hours and len(hours) >= 2
    jobs.refresh_risk(store)
    assert store.read("region_risk").groupBy("window_end").count().filter("count <> 6").isEmpty()


def test_in_stream_dedupe(spark, tmp_path):
    (tmp_path / "in").mkdir()
    row = {"event_id": "V-1", "event_time": "2024-01-01T00:05:00.000+00:00"}
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps(row | {"event_id": i}) for i in ("V-1", "V-1", "V-2")))
    stream = jobs.without_replays(stream_json(spark, str(tmp_path / "in"), schemas.READING))
    seen = []
    query = jobs.start_feed(stream, "dedupe", lambda batch, _: seen.extend(r[0] for r in batch.select("event_id").collect()),
                            str(tmp_path / "cp"), "once")
    query.awaitTermination()
    assert sorted(seen) == ["V-1", "V-2"]


def test_a_replay_in_a_later_batch_never_reaches_the_handler(spark, tmp_path):
    """Also after a restart, also when the copy is late, and never at the cost of a valid copy."""
    from surveil.operators.validate import reading_rules
    good = {"event_id": "V-1", "patient_id": "P", "region_id": "R1", "event_time": "2024-01-05T00:05:00.000+00:00", "heart_rate": 80, "systolic_bp": 120,
            "diastolic_bp": 80, "oxygen_saturation": 97.0, "body_temperature": 37.0, "respiratory_rate": 16, "latitude": 12.9, "longitude": 77.5,
            "created_at": "2024-01-05T00:05:00.000+00:00"}
    (tmp_path / "in").mkdir()
    seen = []

    def drain(number, *rows):
        (tmp_path / "in" / f"{number}.json").write_text("\n".join(map(json.dumps, rows)) + "\n")
        stream = jobs.without_replays(stream_json(spark, str(tmp_path / "in"), schemas.READING), rules=reading_rules())
        query = jobs.start_feed(stream, "once-only", lambda batch, _: seen.append([(r["event_id"], r["heart_rate"]) for r in batch.collect()]), str(tmp_path / "cp"), "once")
        query.awaitTermination()
        done, seen[:] = sorted((x for batch in seen for x in batch), key=str), []     # a batch without rows moves the watermark
        return done
    assert drain(0, good, good | {"event_id": "V-2", "heart_rate": None}) == [("V-1", 80), ("V-2", None)]
    late = "2023-01-01T00:05:00.000+00:00"
    rows = [good, good | {"event_time": late}, good | {"event_id": "V-2"}, good | {"event_id": "V-2", "heart_rate": None}, good | {"event_id": "V-3", "event_time": late}]
    assert drain(1, *rows) == [("V-2", 80), ("V-2", None), ("V-3", 80)]
    assert drain(2, *rows, good | {"event_id": "V-4"}) == [("V-2", None), ("V-4", 80)]


def test_continuous_mode_stops_and_raises(spark, tmp_path):
    for name in ("v", "r"):
        (tmp_path / name).mkdir()
    store = Store(spark, str(tmp_path / "store"))
    jobs.run(spark, store, str(tmp_path / "v"), str(tmp_path / "r"), score, "continuous", stop_after=3)
    assert not spark.streams.active
    row = {n: None for n in schemas.READING.names} | {"event_id": "V-1"}
    (tmp_path / "v" / "a.json").write_text(json.dumps(row))

    def failing(_):
        raise ValueError("no model today")
    with pytest.raises(Exception, match="no model today"):
        jobs.run(spark, store, str(tmp_path / "v"), str(tmp_path / "r"), failing, "continuous", stop_after=60)
    assert not spark.streams.active
    with pytest.raises(ValueError, match="Unknown mode"):
        jobs.start_feed(stream_json(spark, str(tmp_path / "v"), schemas.READING), "x", lambda *_: None, str(tmp_path / "c"), "weekly")
