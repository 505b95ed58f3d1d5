"""Schemas of the feeds, the labels and the stored result tables."""

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
          "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType()}


def fields(text: str) -> T.StructType:
    """A flat schema from "name type, ..." (works before a session exists)."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


READING = fields(
    "event_id string, patient_id string, region_id string, event_time timestamp,"
    " heart_rate int, systolic_bp int, diastolic_bp int, oxygen_saturation double,"
    " body_temperature double, respiratory_rate int, latitude double, longitude double,"
    " created_at timestamp"
)
REPORT = fields(
    "event_id string, event_time timestamp, region_id string, region_name string,"
    " latitude double, longitude double, symptom_category string, severity int,"
    " case_count int, created_at timestamp"
)
READING_LABEL = fields(
    "event_id string, is_anomaly boolean, anomaly_type string, is_corrupt boolean,"
    " corruption_type string"
)
REPORT_LABEL = fields(
    "event_id string, is_outbreak_event boolean, outbreak_id string"
)
OUTBREAK = fields(
    "outbreak_id string, center_latitude double, center_longitude double, radius_km double,"
    " symptom_category string, start_tick int, end_tick int, start_time timestamp,"
    " end_time timestamp"
)

STORED_READING = fields(
    "event_id string, patient_id string, region string, event_time timestamp,"
    " created_at timestamp, processed_at timestamp, heart_rate int, systolic_bp int,"
    " diastolic_bp int, oxygen_saturation double, body_temperature double,"
    " respiratory_rate int, latitude double, longitude double, anomaly_score double,"
    " predicted_anomaly boolean, latency_seconds double"
)
STORED_REPORT = fields(
    "event_id string, region string, event_time timestamp, created_at timestamp,"
    " processed_at timestamp, latitude double, longitude double, symptom_type string,"
    " severity int, case_count int, latency_seconds double"
)
ASSIGNMENT = fields(
    "event_id string, window_end timestamp, cluster_id string, in_cluster boolean"
)
CLUSTER = fields(
    "cluster_id string, window_end timestamp, calculated_at timestamp, region string,"
    " center_latitude double, center_longitude double, event_count bigint, total_cases bigint"
)
REGION_RISK = fields(
    "region string, window_end timestamp, calculated_at timestamp, anomaly_rate double,"
    " clustered_cases bigint, anomaly_part double, cluster_part double, risk_score double,"
    " risk_level string"
)
FORECAST = fields(
    "kind string, name string, forecast_time timestamp, predicted_cases double, lower_cases double, upper_cases double,"
    " generated_at timestamp, history_points bigint"
)
EVALUATION = fields(
    "detector string, items bigint, precision double, recall double, f1 double,"
    " false_positive_rate double, true_positives bigint, false_positives bigint,"
    " false_negatives bigint, true_negatives bigint"
)
STREAM_PROGRESS = fields(
    "feed string, batch_id bigint, started_at timestamp, batch_ms bigint, write_ms bigint, rows_read bigint,"
    " rows_per_second double, state_rows bigint, state_bytes bigint, replays_dropped bigint"
)
COMMIT = fields("seq bigint, table string, day date, slot string, commit string")
BATCH_METRICS = fields(
    "feed string, batch_id bigint, rows_read bigint, rows_rejected bigint, rows_new bigint,"
    " rows_flagged bigint, recorded_at timestamp"
)
