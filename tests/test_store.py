"""Result store and file sources."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from surveil import schemas
from surveil.sources import files
from surveil.sources.store import TABLES, Store

T0 = datetime(2024, 1, 1, 0, 5)


@pytest.fixture
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path / "store"))
    made.create()
    return made


def report(i, minutes, lag=0.0, region="R1"):
    t = T0 + timedelta(minutes=minutes)
    return (f"G-{i}", region, t, t + timedelta(seconds=lag), t, 12.9, 77.5, "fever", 1, 2, lag)


def reports(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.STORED_REPORT)


def test_status_names_and_unknown_tables(spark, tmp_path):
    store = Store(spark, str(tmp_path / "none"))
    assert store.status() == "missing"
    store.create()
    assert store.status() == "empty" and store.table_names() == set()
    for name, (schema, _) in TABLES.items():
        frame = store.read(name)
        assert frame.count() == 0 and frame.columns == schema.names
    with pytest.raises(ValueError, match="Unknown table"):
        store.read("other")
    assert {r["table_name"]: r["rows"] for r in store.counts().collect()}["geo_events"] == 0
    assert store.newest_micros("geo_events") is None


@pytest.mark.parametrize("same_day", [False, True])
def test_first_stored_copy_wins(spark, store, same_day):
    def insert(*rows):
        frame = reports(spark, *rows)
        return store.insert_if_absent("geo_events", frame, store.days_of(frame) if same_day else None)
    assert insert(report(1, 0), report(2, 60), report(1, 0, 9.0)) == 2
    assert insert(report(1, 0, 60.0), report(3, 1500)) == 1
    assert insert() == 0
    kept = {r["event_id"]: r["latency_seconds"] for r in store.read("geo_events").collect()}
    assert kept == {"G-1": 0.0, "G-2": 0.0, "G-3": 0.0}
    assert store.newest_micros("geo_events") == int((T0 + timedelta(minutes=1500)).replace(tzinfo=timezone.utc).timestamp() * 1e6)


def test_a_copy_with_another_event_time_is_found(spark, store):
    assert store.insert_if_absent("geo_events", reports(spark, *[report(i, 60 * i) for i in range(30)])) == 30
    moved = reports(spark, *[report(i, 60 * i + 5000) for i in range(40)])     # days later, most ids known
    assert store.insert_if_absent("geo_events", moved) == 10
    assert store.insert_if_absent("geo_events", moved) == 0
    assert store.read("geo_events").count() == 40 == store.read("geo_events").select("event_id").distinct().count()
    plan = store._keys("geo_events", [1, 2])._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan


def test_a_batch_that_failed_before_its_keys_were_added_is_not_stored_twice(spark, store, monkeypatch):
    def broken(*_):
        raise OSError("disk gone")
    with monkeypatch.context() as m:
        m.setattr(store, "_add_keys", broken)
        with pytest.raises(OSError):
            store.insert_if_absent("geo_events", reports(spark, report(1, 0), report(2, 60)))
    assert store.insert_if_absent("geo_events", reports(spark, report(1, 0), report(2, 60), report(3, 0))) == 1
    assert store.read("geo_events").count() == 3
    # a store from before the key table gets one
    from surveil.session import delete_path
    delete_path(spark, f"{store.root}/_keys")
    assert store.insert_if_absent("geo_events", reports(spark, report(1, 9000), report(4, 0))) == 1


def test_tables_of_a_transaction_change_together(spark, store):
    both = cluster(spark, 1, 3)
    end = datetime(2024, 1, 1, 1)
    assigned = spark.createDataFrame([("G-1", end, "c-0", True)], schemas.ASSIGNMENT)
    with store.transaction() as put:
        put("clusters", both)
        put("assignments", assigned)
        assert store.read("clusters").count() == 0 == store.read("assignments").count()     # a reader in between
    assert (store.read("clusters").count(), store.read("assignments").count()) == (3, 1)
    with pytest.raises(RuntimeError):
        with store.transaction() as put:
            put("clusters", cluster(spark, 1, 1))
            raise RuntimeError("no")
    assert store.read("clusters").count() == 3
    assert store.read_days("clusters", ["2024-01-01"]).count() == 3 and store.read_days("clusters", ["2024-01-02"]).count() == 0
    assert store.vacuum() == 1 and store.vacuum() == 0 and store.read("clusters").count() == 3
    with pytest.raises(ValueError, match="is not replaced"):
        with store.transaction() as put:
            put("geo_events", reports(spark, report(1, 0)))


def test_two_writers_cannot_take_one_commit(spark, store):
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: store._publish([("forecasts", None, None, f"c{i}")]), range(12)))
    assert sorted(numbers) == list(range(1, 13))
    assert [(r["commit"], r["seq"]) for r in store.commits().collect()] == [(f"c{numbers.index(12)}", 12)]
    assert store.commits(5).first()["seq"] == 5
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda v: store.replace("forecasts", forecast(spark, [v] * 3)), [1.0, 2.0]))
    assert {r["predicted_cases"] for r in store.read("forecasts").collect()} in ({1.0}, {2.0})


def test_range_is_open_left_and_prunes_days(spark, store):
    store.insert_if_absent("geo_events", reports(spark, *[report(i, 30 * i) for i in range(100)]))
    start = datetime(2024, 1, 1, 1, 5)
    frame = store.read_range("geo_events", start, start + timedelta(hours=1))
    assert sorted(r["event_id"] for r in frame.collect()) == ["G-3", "G-4"]
    assert "PartitionFilters: [isnotnull(day" in frame._jdf.queryExecution().toString()


def cluster(spark, hour, number):
    end = datetime(2024, 1, 1, hour)
    return spark.createDataFrame([(f"{end:%Y%m%dT%H%M}-{n}", end, end, "R1", 1.0, 2.0, 5, 9) for n in range(number)],
                                 schemas.CLUSTER)


def test_overwrite_touches_only_its_windows(spark, store):
    store.overwrite_windows("clusters", cluster(spark, 1, 3).unionByName(cluster(spark, 2, 2)))
    store.overwrite_windows("clusters", cluster(spark, 1, 1))     # fewer clusters: no stale rows stay
    assert sorted(r["cluster_id"] for r in store.read("clusters").collect()) == [
        "20240101T0100-0", "20240101T0200-0", "20240101T0200-1"]


def test_a_recomputed_window_without_rows_is_empty(spark, store):
    both = cluster(spark, 1, 3).unionByName(cluster(spark, 2, 2))
    store.overwrite_windows("clusters", both, store.windows_of(both))
    store.overwrite_windows("clusters", cluster(spark, 2, 1), store.windows_of(both))
    assert [r["cluster_id"] for r in store.read("clusters").collect()] == ["20240101T0200-0"]


def test_last_assignment_decides(spark, store):
    store.insert_if_absent("geo_events", reports(spark, report(1, 0), report(2, 1)))
    one, two = datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 2)
    rows = [("G-1", two, None, False), ("G-1", one, "c-0", True)]
    store.overwrite_windows("assignments", spark.createDataFrame(rows, schemas.ASSIGNMENT))
    got = {r["event_id"]: (r["cluster_id"], r["in_cluster"]) for r in store.geo_events().collect()}
    assert got == {"G-1": (None, False), "G-2": (None, False)}


def forecast(spark, values):
    return spark.createDataFrame([("total", "all", T0 + timedelta(minutes=15 * i), v, 0.0, 9.0, T0, 12) for i, v in enumerate(values)],
                                 schemas.FORECAST)


def test_forecast_is_replaced_or_kept_whole(spark, store):
    store.replace("forecasts", forecast(spark, [1.0, 2.0, 3.0]))
    store.replace("forecasts", forecast(spark, [4.0, 5.0]))
    assert sorted(r["predicted_cases"] for r in store.read("forecasts").collect()) == [4.0, 5.0]
    broken = forecast(spark, [6.0]).withColumn("predicted_cases", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception):
        store.replace("forecasts", broken)
    assert sorted(r["predicted_cases"] for r in store.read("forecasts").collect()) == [4.0, 5.0]


def test_not_a_number_is_stored_as_null(spark, store):
    store.replace("forecasts", forecast(spark, [float("nan")]))
    assert store.read("forecasts").first()["predicted_cases"] is None


def test_reset_deletes_stores_only(spark, store, tmp_path):
    (tmp_path / "other").mkdir()
    with pytest.raises(ValueError, match="is not a store"):
        Store(spark, str(tmp_path / "other")).reset()
    store.insert_if_absent("geo_events", reports(spark, report(1, 0)))
    store.reset()
    assert store.status() == "missing"


def test_csv_json_and_documents(spark, tmp_path):
    rows = spark.createDataFrame([("V-1", True, "fever", False, "none"), ("V-2", False, "none", True, "x")], schemas.READING_LABEL)
    files.write_csv(rows, str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), schemas.READING_LABEL)
    assert sorted(back.collect()) == sorted(rows.collect())
    with pytest.raises(AnalysisException):
        files.write_csv(rows, str(tmp_path / "csv"))               # refuse ...
    files.write_csv(rows.limit(1), str(tmp_path / "csv"), fresh=True)   # ... or replace
    assert files.read_csv(spark, str(tmp_path / "csv"), schemas.READING_LABEL).count() == 1
    files.write_json_lines(rows, str(tmp_path / "json"))
    files.write_json_lines(rows.limit(1), str(tmp_path / "json"), append=True)
    labels = files.read_json_lines(spark, str(tmp_path / "json"), schemas.READING_LABEL)
    assert tuple(files.count_labels(labels).first())[0] == 3

    (tmp_path / "outbreaks.json").write_text(json.dumps(
        [{"outbreak_id": "OB-1", "radius_km": 1.0, "start_time": "2026-01-01T01:00:00.000+00:00"}], indent=2))
    assert files.read_document(spark, str(tmp_path / "outbreaks.json"), schemas.OUTBREAK).first()["start_time"].hour == 1
    (tmp_path / "broken.json").write_text("{ not json")
    assert files.read_document(spark, str(tmp_path / "broken.json"), schemas.EVALUATION).count() == 0
    assert files.read_document(spark, str(tmp_path / "missing.json"), schemas.EVALUATION).count() == 0


def test_csv_times_are_utc(spark, tmp_path):
    (tmp_path / "r.csv").write_text("event_id,event_time\nG-1,2026-01-01T05:30:00.000+05:30\n")
    row = files.read_csv(spark, str(tmp_path / "r.csv"), schemas.fields("event_id string, event_time timestamp")).select(
        F.date_format("event_time", "HH:mm")).first()
    assert row[0] == "00:00"
