"""Fixed values that decide results (ranges, thresholds, names).

They are part of the data contract, so they are stated as plain values here
and nowhere else.
"""

# Regions with their centres.
REGIONS = [
    ("R1", "North District", 13.030, 77.590),
    ("R2", "South District", 12.910, 77.590),
    ("R3", "East District", 12.970, 77.660),
    ("R4", "West District", 12.970, 77.520),
    ("R5", "Central District", 12.970, 77.590),
    ("R6", "Lake District", 13.020, 77.660),
]
REGION_IDS = [region[0] for region in REGIONS]

# Vital signs used by the model, and their valid ranges (both ends count).
VITALS = [
    "heart_rate", "systolic_bp", "diastolic_bp",
    "oxygen_saturation", "body_temperature", "respiratory_rate",
]
VITAL_RANGES = {
    "heart_rate": (20, 250),
    "systolic_bp": (50, 260),
    "diastolic_bp": (20, 160),
    "oxygen_saturation": (50, 100),
    "body_temperature": (30, 44),
    "respiratory_rate": (4, 60),
}
SEVERITY_RANGE = (1, 4)

# Fields a record must carry.
READING_REQUIRED = [
    "event_id", "patient_id", "region_id", "event_time", "created_at",
    "latitude", "longitude", *VITALS,
]
REPORT_REQUIRED = [
    "event_id", "region_id", "event_time", "created_at", "latitude",
    "longitude", "symptom_category", "severity", "case_count",
]

# Truth columns a detector must never see.
TRUTH_COLUMNS = {
    "is_anomaly", "anomaly_type", "is_corrupt", "corruption_type",
    "is_outbreak_event", "outbreak_id",
}

# Named abnormal patterns, as bounds per vital sign.
PATTERNS = {
    "tachycardia_hypoxia": {"heart_rate": (125, 160), "oxygen_saturation": (82, 90),
                            "respiratory_rate": (24, 32)},
    "fever": {"body_temperature": (38.8, 40.5), "heart_rate": (100, 125),
              "respiratory_rate": (20, 26)},
    "hypotension": {"systolic_bp": (75, 90), "diastolic_bp": (40, 55),
                    "heart_rate": (105, 130)},
    "hypertensive_crisis": {"systolic_bp": (180, 210), "diastolic_bp": (115, 130)},
    "bradycardia": {"heart_rate": (35, 48)},
}
PULSE_PRESSURE_MIN = 10

# Geometry.
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.32

# Detectors.
FOREST_TREES = 200
FOREST_CONTAMINATION = 0.03
FOREST_SEED = 42
CLUSTER_EPS_KM = 0.5
CLUSTER_MIN_SAMPLES = 5
CLUSTER_WINDOW_MINUTES = 60

# Risk heuristic.
RISK_FULL_ANOMALY_RATE = 0.10
RISK_FULL_CASES = 20
RISK_MEDIUM = 30
RISK_HIGH = 60

# Forecast.
BIN_MINUTES = 15
FORECAST_STEPS = 8
FORECAST_MIN_BINS = 12
FORECAST_BAND_Z = 1.2816  # 80 % of a normal distribution lies within +-1.2816 sd

# Simulated clock and stream triggers.
TICK_MINUTES = 5
FILES_PER_TRIGGER = 10
TRIGGER_SECONDS = 2
