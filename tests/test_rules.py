"""Small golden cases: validation, risk, history, latency, scans, labels."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from surveil.functions import clock, display, geo
from surveil.functions.risk import risk_columns, risk_level
from surveil.operators import evaluate, forecast, history, keyed, validate
from surveil.operators.quantiles import exact_quantiles
from surveil.plans import reports, risk

T0 = datetime(2024, 1, 1)


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def test_risk_score(spark):
    cases = [(0.0, 0), (0.05, 0), (0.10, 0), (0.10, 4), (0.5, 500)]
    frame = spark.createDataFrame(cases, "rate double, cases bigint")
    out = frame.select(*[c.alias(n) for n, c in risk_columns(F.col("rate"), F.col("cases")).items()])
    assert rows_of(out) == [(0.0, 0.0, 0.0, "Low"), (0.5, 0.0, 25.0, "Low"), (1.0, 0.0, 50.0, "Medium"),
                            (1.0, 0.2, 60.0, "High"), (1.0, 1.0, 100.0, "High")]
    levels = spark.createDataFrame([(x,) for x in (0.0, 29.99, 30.0, 59.99, 60.0, 100.0)], "s double")
    assert [r[0] for r in levels.select(risk_level(F.col("s"))).collect()] == [
        "Low", "Low", "Medium", "Medium", "High", "High"]


def reports_at(spark, minutes_and_cases):
    return spark.createDataFrame(
        [(T0 + timedelta(minutes=m), c, "R1", "fever") for m, c in minutes_and_cases],
        "event_time timestamp, case_count int, region string, symptom_type string")


def test_history_fills_gaps_and_drops_an_unfinished_bin(spark):
    rows = reports_at(spark, [(0, 2), (5, 1), (10, 3), (30, 4), (35, 1), (40, 1), (45, 5)])
    got = rows_of(history.case_history(rows).orderBy("ds"))
    assert got == [(T0, 6.0), (T0 + timedelta(minutes=15), 0.0), (T0 + timedelta(minutes=30), 6.0)]
    total = history.series_history(rows).filter("kind = 'total'").orderBy("x")
    assert [(r["x"], r["y"]) for r in total.collect()] == [(0, 6.0), (1, 0.0), (2, 6.0)]
    assert history.case_history(rows.limit(0)).count() == 0


def test_forecast_starts_after_the_last_complete_bin(spark):
    rows = reports_at(spark, [(5 * i, 1 + i % 3) for i in range(72)])
    series = history.series_history(rows).filter("kind = 'total'")
    assert history.require_history(series) == 24
    for method in (forecast.trend_forecast, forecast.piecewise_forecast):
        got = method(series).orderBy("forecast_time").collect()
        assert len(got) == 8 and got[0]["forecast_time"] == T0 + timedelta(hours=6)
        assert all(r["history_points"] == 24 and 0 <= r["lower_cases"] <= r["predicted_cases"] <= r["upper_cases"]
                   for r in got)
        assert abs(got[0]["predicted_cases"] - 6.0) < 0.01


def test_too_little_history(spark):
    series = history.series_history(reports_at(spark, [(5 * i, 1) for i in range(9)]))
    assert {r["eligible"] for r in history.eligibility(series).collect()} == {False}
    assert forecast.trend_forecast(series).count() == 0 and forecast.piecewise_forecast(series).count() == 0
    with pytest.raises(ValueError, match="Only 3 complete bins"):
        history.require_history(series.filter("kind = 'total'"))


def test_forecast_values_are_never_negative(spark):
    frame = spark.createDataFrame([(-1.5,), (3.25,), (-9.0,), (1.004,)], "v double")
    assert [r[0] for r in frame.select(display.non_negative(F.col("v"))).collect()] == [0.0, 3.25, 0.0, 1.0]


def test_windows_are_open_left_and_closed_right(spark):
    times = [T0 + timedelta(minutes=m) for m in (5, 60, 90, 120)]
    frame = spark.createDataFrame([(f"E{i}", t) for i, t in enumerate(times)], "event_id string, event_time timestamp")
    got = rows_of(frame.select(clock.window_end(F.col("event_time"))))
    assert [r[0].hour for r in got] == [1, 1, 2, 2]
    scan = reports.range_scan(frame, T0 + timedelta(hours=1), T0 + timedelta(hours=2))
    assert [r["event_id"] for r in scan.collect()] == ["E2", "E3"]
    assert reports.range_scan(frame).count() == 4
    sliding = frame.filter("event_id = 'E1'").select(clock.window_end(F.col("event_time"), 60, 15))
    assert sorted(r[0].minute + 60 * r[0].hour for r in sliding.collect()) == [60, 75, 90, 105]


def test_utc_text_and_ticks(spark):
    frame = spark.createDataFrame([(datetime(2024, 1, 1, 2, 5, 0, 123999),)], "t timestamp")
    start = F.lit(T0)
    tick = clock.tick_of(F.col("t"), start)
    assert rows_of(frame.select(clock.utc_text(F.col("t")), tick, clock.tick_time(tick, start))) == [
        ("2024-01-01T02:05:00.123+00:00", 25, datetime(2024, 1, 1, 2, 5))]


READING = dict(event_id="V-1", patient_id="P-1", region_id="R1", event_time=T0, created_at=T0, latitude=12.9,
               longitude=77.5, heart_rate=72, systolic_bp=120, diastolic_bp=80, oxygen_saturation=97.5,
               body_temperature=36.8, respiratory_rate=16)


@pytest.mark.parametrize("change, reason", [
    ({}, None), ({"heart_rate": 20}, None), ({"heart_rate": 19}, "heart_rate_out_of_range"),
    ({"heart_rate": None}, "missing_heart_rate"), ({"oxygen_saturation": float("nan")}, "missing_oxygen_saturation"),
    ({"oxygen_saturation": 100.0}, None), ({"oxygen_saturation": 100.1}, "oxygen_saturation_out_of_range"),
    ({"systolic_bp": 80}, "systolic_not_above_diastolic"), ({"respiratory_rate": -4}, "respiratory_rate_out_of_range"),
    ({"latitude": 999.0}, None)])
def test_reading_rules(spark, change, reason):
    schema = ("event_id string, patient_id string, region_id string, event_time timestamp, created_at timestamp,"
              " latitude double, longitude double, heart_rate int, systolic_bp int, diastolic_bp int,"
              " oxygen_saturation double, body_temperature double, respiratory_rate int")
    row = READING | change
    frame = spark.createDataFrame([tuple(row[f.split()[0]] for f in schema.split(", ") if f.strip())], schema)
    assert validate.with_reason(frame, validate.reading_rules()).first()["reject_reason"] == reason
    assert validate.valid_readings(frame).count() == (reason is None)


def test_first_copy_and_absent(spark):
    batch = spark.createDataFrame([("a", 2, "late"), ("a", 1, "first"), ("b", 1, "b"), ("c", 5, "c")],
                                  "event_id string, created_at int, v string")
    stored = spark.createDataFrame([("c", 1, "old")], batch.schema)
    assert sorted(rows_of(keyed.insert_if_absent(batch, stored))) == [("a", 1, "first"), ("b", 1, "b")]
    assert rows_of(keyed.duplicate_keys(batch, "event_id")) == [("a", 2)]
    assert sorted(rows_of(keyed.latest_per_key(batch, "event_id", "created_at")))[0] == ("a", 2, "late")


def test_quantiles_interpolate(spark):
    import numpy as np
    values = [float(x) for x in np.random.default_rng(3).integers(0, 50, 997)] + [None]
    frame = spark.createDataFrame([("k", v) for v in values], "g string, v double")
    row = exact_quantiles(frame, ["g"], "v", {"m": 0.5, "p": 0.95, "z": 0.0}).first()
    known = [v for v in values if v is not None]
    assert abs(row["m"] - np.quantile(known, 0.5)) < 1e-9 and abs(row["p"] - np.quantile(known, 0.95)) < 1e-9
    assert row["z"] == min(known)


def test_latency_summary(spark):
    rows = [("vitals", T0 + timedelta(minutes=5 * i), 2.0) for i in range(48)] + [("reports", T0, 1.0)]
    out = {r["feed"]: r for r in reports.latency_summary(
        spark.createDataFrame(rows, "feed string, processed_at timestamp, latency_seconds double")).collect()}
    assert out["vitals"]["median_latency"] == out["vitals"]["p95_latency"] == out["vitals"]["max_latency"] == 2.0
    assert out["vitals"]["throughput"] == round(48 / (47 * 300), 6) and out["reports"]["throughput"] is None


def test_confusion_metrics_and_undefined_shares(spark):
    rows = spark.createDataFrame([(True, True), (True, False), (False, False), (False, True), (False, False)],
                                 "a boolean, p boolean")
    row = evaluate.confusion_metrics(rows, "a", "p").first()
    assert (row["precision"], row["recall"], row["f1"], row["false_positive_rate"]) == (0.5, 0.5, 0.5, 0.3333)
    none = evaluate.confusion_metrics(rows.limit(0), "a", "p").first()
    assert (none["precision"], none["recall"], none["f1"], none["items"]) == (0.0, 0.0, 0.0, 0)


def test_labels_must_be_one_to_one(spark):
    verdicts = spark.createDataFrame([("a", True), ("b", False)], "event_id string, v boolean")
    labels = spark.createDataFrame([("a", True), ("a", False)], "event_id string, l boolean")
    assert rows_of(evaluate.label_audit(verdicts, labels)) == [(1, 1, 0, 1)]
    with pytest.raises(Exception, match="not one label per verdict"):
        evaluate.label_join(verdicts, labels, strict=True).collect()


def test_evaluation_table_keeps_older_results(spark):
    new = evaluate.confusion_metrics(spark.createDataFrame([(True, True)], "a boolean, p boolean"), "a", "p")
    table = reports.evaluation_table(("new", new), ("old", new.drop("false_positive_rate"))).collect()
    assert [r["false_positive_rate"] for r in table] == [0.0, None]
    percent = spark.range(1).select(display.percent_text(F.lit(0.7042))).first()[0]
    assert percent == "70.4%"


def test_latest_window_logic(spark):
    risk_rows = spark.createDataFrame(
        [("R1", T0, 10.0, "Low"), ("R1", T0 + timedelta(hours=1), 40.0, "Medium"), ("R2", T0 + timedelta(hours=1), 40.0, "Medium")],
        "region string, window_end timestamp, risk_score double, risk_level string")
    old = spark.createDataFrame([("old-0", T0)], "cluster_id string, window_end timestamp")
    assert reports.latest_rows(risk_rows).count() == 2
    assert reports.latest_rows(old, risk_rows).count() == 0        # an older cluster is not active
    readings = spark.createDataFrame([(True,), (False,)], "predicted_anomaly boolean")
    row = reports.headline(readings, readings, old, reports.latest_rows(risk_rows)).first()
    assert (row["patient_events"], row["patient_anomalies"], row["cluster_records"], row["clusters_latest_window"]) == (2, 1, 1, 0)
    assert (row["top_risk_region"], row["top_risk_score"]) == ("R1", 40.0)
    empty = reports.headline(readings, readings, old, risk_rows.limit(0)).first()
    assert empty["top_risk_region"] is None and empty["cluster_records"] == 1


def test_risk_has_six_regions_and_skips_unknown_ones(spark):
    members = spark.createDataFrame([("e", T0, "R9", 30, True), ("f", T0, "R2", 4, True)],
                                    "event_id string, window_end timestamp, region string, case_count int, in_cluster boolean")
    readings = spark.createDataFrame([(T0, "R2", True), (T0, "R2", False), (T0 - timedelta(minutes=60), "R3", True)],
                                     "event_time timestamp, region string, predicted_anomaly boolean")
    out = {r["region"]: r for r in risk.risk_of_windows(members, readings).collect()}
    assert sorted(out) == ["R1", "R2", "R3", "R4", "R5", "R6"]
    assert (out["R2"]["anomaly_rate"], out["R2"]["clustered_cases"], out["R2"]["risk_score"]) == (0.5, 4, 60.0)
    assert out["R3"]["anomaly_rate"] == 0.0                        # exactly an hour old: outside


def test_filters(spark):
    rows = spark.createDataFrame(
        [(T0, "R1", True, 1, "fever"), (T0 + timedelta(hours=1), "R2", False, 2, None), (None, "R1", True, 3, "rash")],
        "event_time timestamp, region string, predicted_anomaly boolean, severity int, symptom_type string")
    end = T0 + timedelta(hours=1)
    assert reports.filter_readings(rows, T0, end, ["R1", "R2"]).count() == 2
    assert reports.filter_readings(rows, T0, end, ["R1", "R2"], True).count() == 1
    assert reports.filter_readings(rows, T0, end, []).count() == 0
    assert reports.filter_reports(rows, T0, end, ["R1", "R2"], [1, 2], ["fever", "rash"]).count() == 1


def test_positions(spark):
    frame = spark.createDataFrame([(12.97, 77.59), (13.03, 77.59), (12.999, 77.59)], "latitude double, longitude double")
    near = frame.select(geo.nearest_region("latitude", "longitude").alias("n")).select("n.region", "n.distance_km").collect()
    assert [r[0] for r in near][:2] == ["R5", "R1"] and near[0][1] == 0.0
    moved = frame.limit(1).select(geo.offset_latitude("latitude", "1.0D"), geo.offset_longitude("latitude", "longitude", "1.0D")).first()
    assert moved[0] == round(12.97 + 1 / 111.32, 6) and 77.59 < moved[1] < 77.6


def test_label_columns_are_found_at_any_depth(spark):
    frame = spark.sql("SELECT 1 AS Is_Anomaly, named_struct('outbreak_id', 2) AS s, array(named_struct('is_corrupt', 3)) AS a, 4 AS event_id")
    assert validate.label_columns(frame.schema) == ["Is_Anomaly", "outbreak_id", "is_corrupt"]


def test_a_verdict_needs_exactly_one_label(spark):
    verdicts = spark.createDataFrame([("a", True), ("b", False)], "event_id string, flag boolean")
    labels = spark.createDataFrame([("a", True), ("b", True), ("c", True)], "event_id string, truth boolean")
    assert sorted(map(tuple, evaluate.label_join(verdicts, labels).collect())) == [("a", True, True), ("b", False, True)]
    for left, right in ((verdicts, labels.filter("event_id <> 'b'")), (verdicts, labels.union(labels)), (verdicts.union(verdicts), labels)):
        with pytest.raises(Exception, match="not one label per verdict"):
            evaluate.label_join(left, right).collect()
    assert evaluate.label_join(verdicts, labels.filter("event_id = 'a'"), strict=False).count() == 1


def test_display(spark):
    row = spark.range(1).select(display.region_name(F.lit("R6")), display.region_name(F.lit("R9")),
                                display.yes_no(F.lit(False)), display.nan_to_null(F.lit(float("nan")))).first()
    assert tuple(row) == ("Lake District", None, "No", None)


def test_outbreak_membership(spark):
    from surveil.operators.outbreaks import outbreak_members
    outbreak = spark.createDataFrame([("OB-1", 12.97, 77.59, 1.0, "fever", T0, T0 + timedelta(minutes=90))],
                                     "outbreak_id string, center_latitude double, center_longitude double,"
                                     " radius_km double, symptom_category string, start_time timestamp, end_time timestamp")
    rows = spark.createDataFrame(
        [("in", T0, 12.975, 77.59, "fever"), ("other", T0 + timedelta(minutes=89), 12.97, 77.59, "rash"),
         ("late", T0 + timedelta(minutes=90), 12.97, 77.59, "fever"), ("far", T0, 12.98, 77.59, "fever")],
        "event_id string, event_time timestamp, latitude double, longitude double, symptom_type string")
    assert sorted(r["event_id"] for r in outbreak_members(rows, outbreak).collect()) == ["in", "other"]
    assert [r["event_id"] for r in outbreak_members(rows, outbreak, same_symptom=True).collect()] == ["in"]
