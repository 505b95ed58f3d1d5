"""One entry per operator: (spark, data folder) -> DataFrame."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.fixtures import FIXED_FOREST, FIXED_FOREST_NORM, FIXED_FOREST_THRESHOLD, Feeds
from surveil.constants import VITALS
from surveil.functions import clock, geo
from surveil.functions.risk import risk_columns
from surveil.operators import clusters, dbscan, evaluate, forecast, history, iforest, intervals, keyed, neighbours, outbreaks, validate
from surveil.plans import evaluation, reports, risk

START, END = datetime(2024, 1, 10, 6, 0), datetime(2024, 1, 12, 18, 0)
HALF = datetime(2024, 1, 16)
READING_VIEW = ["event_id", "patient_id", "region", "event_time", "created_at", "heart_rate", "systolic_bp",
                "diastolic_bp", "oxygen_saturation", "body_temperature", "respiratory_rate", "predicted_anomaly"]
REPORT_VIEW = ["event_id", "region", "event_time", "created_at", "latitude", "longitude", "symptom_type",
               "severity", "case_count"]


def _fixed_scores(feeds: Feeds) -> DataFrame:
    return iforest.score_boxes(feeds.readings.drop("predicted_anomaly"), FIXED_FOREST, FIXED_FOREST_NORM,
                               FIXED_FOREST_THRESHOLD)


def _members(feeds: Feeds, slide: int | None = None) -> DataFrame:
    return clusters.window_members(feeds.reports_of(*risk.REPORT_COLUMNS).drop("created_at"), slide=slide)


def _labelled(feeds: Feeds) -> DataFrame:
    return dbscan.find_clusters(_members(feeds))


def _latest_risk(feeds: Feeds) -> DataFrame:
    newest = validate.valid_reports(feeds.raw_reports).select("event_time")
    latest = risk.in_latest_window(newest)
    return risk.region_risk(_flags(feeds, latest), feeds.reports_of(*risk.REPORT_COLUMNS, where=latest))


def _flags(feeds: Feeds, where=None) -> DataFrame:
    return feeds.readings_of("event_time", "region", "predicted_anomaly", where=where)


def _cases(feeds: Feeds) -> DataFrame:
    return feeds.reports_of("event_time", "region", "symptom_type", "case_count")


def _series(feeds: Feeds) -> DataFrame:
    return history.series_history(_cases(feeds))


def _verdicts(feeds: Feeds) -> DataFrame:
    return feeds.readings_of("predicted_anomaly").drop("created_at")


def _before(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("created_at") < clock.utc(HALF))


def _places(feeds: Feeds) -> DataFrame:
    return feeds.reports_of("event_time", "latitude", "longitude")


# sources, scans and keyed writes

def label_counts(f):
    return f.reading_labels.agg(F.count("*").alias("rows_written"),
                                F.count_if(F.col("is_corrupt")).alias("corrupt_rows"))


def scan_vitals(f):
    return f.readings.select(*READING_VIEW, "latitude", "longitude", "processed_at", "latency_seconds")


def range_scan_vitals(f):
    return reports.range_scan(f.readings_of(*READING_VIEW, where=reports.after_until(START, END))).select(*READING_VIEW)


def range_scan_reports(f):
    return reports.range_scan(f.reports_of(*REPORT_VIEW, where=reports.after_until(START, END))).select(*REPORT_VIEW)


def insert_if_absent_vitals(f):
    rows = validate.valid_readings(f.raw_readings)
    new = keyed.insert_if_absent(rows, _before(rows))
    return new.withColumnRenamed("region_id", "region").select(*READING_VIEW[:-1])


def insert_if_absent_reports(f):
    rows = validate.valid_reports(f.raw_reports)
    new = keyed.insert_if_absent(rows, _before(rows))
    return new.withColumnsRenamed({"region_id": "region", "symptom_category": "symptom_type"}).select(*REPORT_VIEW)


def latest_assignment(f):
    return clusters.latest_assignment(dbscan.find_clusters(_members(f, slide=30)))


def table_counts(f):
    labelled = _labelled(f)
    return reports.table_counts(_tables(f, labelled))


def _tables(f: Feeds, labelled: DataFrame) -> dict[str, DataFrame]:
    return {
        "vitals_results": f.readings_of("event_time"), "geo_events": f.reports_of("event_time"),
        "clusters": clusters.cluster_summary(labelled),
        "region_risk": risk.risk_of_windows(labelled, _flags(f)),
        "forecasts": forecast.trend_forecast(_series(f))}


# validation and filters

def valid_vitals(f):
    return validate.valid_readings(f.raw_readings).select(
        "event_id", "created_at", "region_id", "heart_rate", "systolic_bp", "diastolic_bp", "oxygen_saturation",
        "body_temperature", "respiratory_rate")


def valid_reports(f):
    return validate.valid_reports(f.raw_reports).select(
        "event_id", "created_at", "region_id", "region_name", "latitude", "longitude", "symptom_category",
        "severity", "case_count")


def reject_counts(f):
    def of(feed, rows, rules):
        return validate.reject_counts(rows, rules).select(F.lit(feed).alias("feed"), "*")
    return of("vitals", f.raw_readings, validate.reading_rules()).unionByName(
        of("reports", f.raw_reports, validate.report_rules()))


def reject_reasons(f):
    return validate.quarantine(f.raw_readings, validate.reading_rules()).select(
        "event_id", "created_at", "reject_reason").unionByName(
        validate.quarantine(f.raw_reports, validate.report_rules()).select(
            "event_id", "created_at", "reject_reason"))


def filter_readings(f):
    regions = ["R1", "R3", "R5"]
    rows = f.readings_of(*READING_VIEW, where=reports.of_regions(START, END, regions))
    return reports.filter_readings(rows, START, END, regions, True).select(*READING_VIEW)


def filter_reports(f):
    regions = ["R2", "R4"]
    rows = f.reports_of(*REPORT_VIEW, where=reports.of_regions(START, END, regions))
    return reports.filter_reports(rows, START, END, regions, [2, 3, 4], ["error", "view"]).select(*REPORT_VIEW)


def store_checks(f):
    labelled = _labelled(f)
    return reports.store_checks(reports.table_counts(_tables(f, labelled)),
                                f.readings_of("processed_at", "latency_seconds"),
                                f.reports_of("processed_at", "latency_seconds"))


# scalar functions

def utc_text(f):
    return f.readings_of("created_at").select("event_id", clock.utc_text(F.col("created_at")).alias("created_text"))


def latency_rows(f):
    return f.readings_of("latency_seconds").select("event_id", "latency_seconds").unionByName(
        f.reports_of("latency_seconds").select("event_id", "latency_seconds"))


def distance_to_region(f):
    centres = reports.regions_table(f.spark).withColumnsRenamed({"latitude": "c_lat", "longitude": "c_lon"})
    return f.reports_of("region", "latitude", "longitude").join(F.broadcast(centres), "region").select(
        "event_id", F.round(geo.haversine_km("latitude", "longitude", "c_lat", "c_lon"), 6).alias("distance_km"))


def offset_position(f):
    return f.reports_of("latitude", "longitude", "case_count", "severity").select(
        "event_id", geo.offset_latitude("latitude", "case_count * 0.5D").alias("new_latitude"),
        geo.offset_longitude("latitude", "longitude", "severity * 0.25D").alias("new_longitude"))


def tick_bucket(f):
    start = clock.utc(datetime(2024, 1, 1)).cast("timestamp_ntz")
    tick = clock.tick_of(F.col("event_time"), start)
    return f.readings_of("event_time").select("event_id", tick.alias("tick"), clock.tick_time(tick, start).alias("tick_time"))


def risk_grid(f):
    """Every patient's share of flagged readings and number of readings, put on the risk scale."""
    shares = f.readings_of("patient_id", "predicted_anomaly").groupBy("patient_id").agg(
        F.avg(F.col("predicted_anomaly").cast("double")).alias("rate"), (F.count("*") % 45).alias("cases"))
    columns = risk_columns(F.col("rate"), F.col("cases"))
    return shares.select("patient_id", "cases", *[c.alias(n) for n, c in columns.items()])


def recent_readings(f):
    return reports.recent_readings(_fixed_scores(f).filter("predicted_anomaly"))


def map_points(f):
    labelled = dbscan.find_clusters(clusters.window_members(
        f.reports_of("event_time", "region", "latitude", "longitude", "symptom_type", "severity", "case_count")))
    return reports.map_points(labelled)


def normalise_vitals(f):
    wobble = validate.valid_readings(f.raw_readings).selectExpr(
        "event_id", "created_at", "heart_rate * 1.013D AS heart_rate", "systolic_bp * 1.017D AS systolic_bp",
        "diastolic_bp * 1.4D AS diastolic_bp", "oxygen_saturation * 0.9931D AS oxygen_saturation",
        "body_temperature * 1.0017D AS body_temperature", "respiratory_rate * 1.07D AS respiratory_rate")
    return validate.normalise_vitals(wobble)


def pattern_tags(f):
    return validate.pattern_tags(f.readings_of(*VITALS), ["event_id"])


# joins

def label_join(f):
    return evaluate.label_join(_verdicts(f), f.reading_labels).select(
        "event_id", "predicted_anomaly", "is_anomaly", "anomaly_type")


def label_join_audit(f):
    return evaluate.label_audit(_verdicts(f), f.reading_labels)


def region_risk(f):
    return risk.region_risk(_flags(f), f.reports_of(*risk.REPORT_COLUMNS))


def risk_map(f):
    return reports.risk_map(_latest_risk(f), reports.regions_table(f.spark))


def semi_filter(f):
    """Readings of patients that were flagged at least once."""
    readings = f.readings_of("patient_id", "event_time", "predicted_anomaly")
    flagged = readings.filter("predicted_anomaly").select("patient_id").distinct()
    return readings.join(flagged, "patient_id", "left_semi").select("event_id", "patient_id", "event_time")


def window_members(f):
    return _members(f, slide=15).select("window_end", "event_id")


def members_at_given_ends(f):
    """Reports in the 45 minutes up to 37 past every hour that has reports: ends that no fixed slide meets."""
    places = f.reports_of("event_time")
    ends = places.select((F.window("event_time", "1 hour").start + F.expr("INTERVAL 37 MINUTES")).alias("window_end")).distinct()
    return intervals.members_at(places, ends, 45).select("window_end", "event_id")


def neighbour_degree(f):
    return neighbours.neighbour_degree(_members(f))


def nearest_region(f):
    found = f.reports_of("region", "latitude", "longitude").select("event_id", "region", geo.nearest_region("latitude", "longitude").alias("near"))
    return found.select("event_id", "region", F.col("near.region").alias("nearest"),
                        F.round("near.distance_km", 6).alias("distance_km"))


def outbreak_members(f):
    reports_ = f.reports_of("event_time", "latitude", "longitude")
    return outbreaks.outbreak_members(reports_, f.outbreaks).select(
        "event_id", "outbreak_id", F.round("distance_km", 6).alias("distance_km"))


# aggregations

def cluster_summary(f):
    """Centres are rounded; the tiny offset keeps means that end in an exact 5 on one side."""
    return clusters.cluster_summary(_labelled(f)).withColumns({
        name: F.round(F.col(name) + 1e-9, 6) for name in ("center_latitude", "center_longitude")})


def case_history(f):
    return history.case_history(_cases(f))


def latest_event_time(f):
    """A second copy cannot change a maximum, so copies stay in."""
    return validate.valid_reports(f.raw_reports).agg(F.max("event_time").alias("latest"))


def headline(f):
    labelled = _labelled(f)
    latest = reports.latest_rows(risk.risk_of_windows(labelled, _flags(f)), labelled)
    return reports.headline(_verdicts(f), f.reports_of("event_time"), clusters.cluster_summary(labelled), latest)


def latency_summary(f):
    def feed(name, rows):
        return rows.select(F.lit(name).alias("feed"), "processed_at", "latency_seconds")
    times = ("processed_at", "latency_seconds")
    return reports.latency_summary(feed("vitals", f.readings_of(*times)).unionByName(feed("reports", f.reports_of(*times))))


def confusion_metrics(f):
    return evaluation.evaluate_flags(_verdicts(f), f.reading_labels)


def recall_by_type(f):
    return evaluate.recall_by_type(label_join(f), "is_anomaly", "predicted_anomaly", "anomaly_type")


def outbreaks_detected(f):
    results = evaluate.label_join(evaluation.causal_flags(_places(f)), f.report_labels)
    return evaluate.outbreaks_detected(results, f.outbreaks)


def reconciliation(f):
    return reports.reconciliation(_verdicts(f), f.reading_labels)


def symptom_options(f):
    return validate.valid_reports(f.raw_reports).select(F.col("symptom_category").alias("symptom_type")).distinct().orderBy(
        "symptom_type")


# latest rows, sorts, unions

def latest_risk(f):
    return _latest_risk(f)


def active_clusters(f):
    labelled = _labelled(f)
    return reports.active_clusters(reports.latest_rows(clusters.cluster_summary(labelled), labelled))


def last_clusters(f):
    """Clusters of the newest window that has any."""
    found = clusters.cluster_summary(_labelled(f))
    return reports.active_clusters(reports.latest_rows(found))


def risk_table(f):
    return reports.risk_table(_latest_risk(f))


def time_extent(f):
    return reports.time_extent(validate.valid_readings(f.raw_readings), validate.valid_reports(f.raw_reports))


# detectors and forecasts

def scaled_vitals(f):
    scaled = iforest.scale_vitals(f.readings_of(*VITALS), ["event_id"])
    return scaled.select("event_id", *[F.round(n, 6).alias(n) for n in scaled.columns if n.startswith("z_")])


def forest_nodes(f):
    nodes = iforest.train(f.readings_of(*VITALS)).nodes
    return nodes.withColumns({name: F.round(name, 9) for name in ("split", "path_len")})


def forest_score_fixed(f):
    return _fixed_scores(f).select("event_id", F.round("anomaly_score", 6).alias("anomaly_score"), "predicted_anomaly")


def forest_flags(f):
    return iforest.train_and_flag(f.readings_of(*VITALS))[1]


def forest_evaluation(f):
    readings = f.readings_of(*VITALS)
    return evaluation.evaluate_forest(_before(readings), readings.filter(F.col("created_at") >= clock.utc(HALF)),
                                      f.reading_labels)


def dbscan_core(f):
    return dbscan.core_and_members(_members(f)).filter("is_core").select("window_end", "event_id")


def dbscan_labels(f):
    return _labelled(f).select("window_end", "event_id", "is_core", "in_cluster", "cluster_no", "cluster_id")


def trend_forecast(f):
    return forecast.trend_forecast(_series(f))


def piecewise_forecast(f):
    return forecast.piecewise_forecast(_series(f))


def forecast_eligibility(f):
    return history.eligibility(_series(f))


def causal_outbreak_flags(f):
    return evaluation.causal_flags(_places(f))


def history_and_forecast(f):
    total = _series(f).filter("kind = 'total'")
    return reports.history_and_forecast(history.case_history(_cases(f)), forecast.trend_forecast(total))


def forecast_staleness(f):
    """A forecast made half-way, against the history there is now."""
    then = history.series_history(_before(_cases(f))).filter("kind = 'total'")
    return reports.forecast_staleness(history.case_history(_cases(f)), forecast.trend_forecast(then))


def evaluation_table(f):
    return reports.evaluation_table(
        ("forest", evaluation.evaluate_flags(_verdicts(f), f.reading_labels)),
        ("dbscan", evaluation.evaluate_clusters(_places(f), f.report_labels)))


REGISTERED = [
    label_counts, scan_vitals, range_scan_vitals, range_scan_reports, insert_if_absent_vitals,
    insert_if_absent_reports, latest_assignment, table_counts, valid_vitals, valid_reports, reject_counts,
    reject_reasons, filter_readings, filter_reports, store_checks, utc_text, latency_rows, distance_to_region,
    offset_position, tick_bucket, risk_grid, recent_readings, map_points, normalise_vitals, pattern_tags,
    label_join, label_join_audit, region_risk, risk_map, semi_filter, window_members, members_at_given_ends, neighbour_degree,
    nearest_region, outbreak_members, cluster_summary, case_history, latest_event_time, headline,
    latency_summary, confusion_metrics, recall_by_type, outbreaks_detected, reconciliation, symptom_options,
    latest_risk, active_clusters, last_clusters, risk_table, time_extent, scaled_vitals, forest_nodes, forest_score_fixed,
    forest_flags, forest_evaluation, dbscan_core, dbscan_labels, trend_forecast, piecewise_forecast,
    forecast_eligibility, causal_outbreak_flags, history_and_forecast, forecast_staleness, evaluation_table,
]


def all_queries() -> dict:
    def bind(query):
        return lambda spark, folder: query(Feeds(spark, folder))
    return {query.__name__: bind(query) for query in REGISTERED}
