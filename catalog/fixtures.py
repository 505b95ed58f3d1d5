"""The surveillance feeds, derived from the ``events`` table by FIXTURES.md part 2."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveil.constants import REGIONS
from surveil.functions.clock import latency_seconds
from surveil.operators.keyed import first_copy
from surveil.operators.validate import valid_readings, valid_reports
from surveil.session import apply_defaults


class Feeds:
    """Views over one data folder. Every property is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = apply_defaults(spark), folder

    @property
    def events(self) -> DataFrame:
        return (
            self.spark.read.parquet(f"{self.folder}/events.parquet")
            .selectExpr("event_id AS e", "ts", "user_id AS u", "event_type",
                        "window(ts, '5 minutes').start AS event_time",
                        "(day(ts) - 1) * 24 + hour(ts) AS hr",
                        "timestampadd(MILLISECOND, CAST(event_id * 37 % 5000 AS INT), ts) AS processed_at",
                        "lpad(CAST(event_id AS STRING), 8, '0') AS number")
            .withColumn("ob", F.expr("hr % 5 IN (1, 2) AND e % 10 < 8"))
        )

    @property
    def raw_readings(self) -> DataFrame:
        rows = self.events.selectExpr(
            "*", "u % 6 + 1 AS place", "IF(e % 37 = 0, e div 37 % 5, -1) AS kind",
            "IF(e % 101 = 5, e div 101 % 4, -1) AS bad",
        ).selectExpr(
            "*",
            "CASE kind WHEN 0 THEN 125 + e % 36 WHEN 1 THEN 100 + e % 26 WHEN 2 THEN 105 + e % 26"
            " WHEN 4 THEN 35 + e % 14 ELSE 62 + e * 31 % 27 END AS pulse",
            "CASE kind WHEN 2 THEN 75 + e % 16 WHEN 3 THEN 180 + e % 31 ELSE 104 + e * 17 % 29 END AS upper_bp",
            "CASE kind WHEN 2 THEN 40 + e % 16 WHEN 3 THEN 115 + e % 16 ELSE 66 + e * 13 % 19 END AS lower_bp",
            "CASE kind WHEN 0 THEN 820 + e * 7 % 81 ELSE 960 + e * 7 % 36 END AS oxygen",
            "CASE kind WHEN 1 THEN 388 + e * 11 % 18 ELSE 364 + e * 11 % 9 END AS warmth",
            "CASE kind WHEN 0 THEN 24 + e % 9 WHEN 1 THEN 20 + e % 7 ELSE 13 + e * 5 % 7 END AS breath",
        ).selectExpr(
            "concat('V-', number) AS event_id", "concat('P-', lpad(CAST(u AS STRING), 4, '0')) AS patient_id",
            "concat('R', CAST(place AS STRING)) AS region_id", "event_time",
            "CAST(IF(bad = 0, NULL, pulse) AS INT) AS heart_rate",
            "CAST(IF(bad = 2, lower_bp, upper_bp) AS INT) AS systolic_bp",
            "CAST(IF(bad = 2, upper_bp + 20, lower_bp) AS INT) AS diastolic_bp",
            "IF(bad = 1, 1010 + e % 190, oxygen) / 10.0D AS oxygen_saturation",
            "warmth / 10.0D AS body_temperature",
            "CAST(IF(bad = 3, -breath, breath) AS INT) AS respiratory_rate",
            f"{_centre('place', 2)} / 1e6D AS latitude", f"{_centre('place', 3)} / 1e6D AS longitude",
            "ts AS created_at", "processed_at", "e % 50 = 0 AS _twice")
        return _with_replays(rows)

    @property
    def raw_reports(self) -> DataFrame:
        rows = self.events.selectExpr(
            "*", "IF(ob, (hr div 5 + 3 * (e % 2)) % 6, u % 6) + 1 AS place",
            "IF(e % 103 = 7, e div 103 % 4, -1) AS bad",
            "e * 7919 % 2001 - 1000 AS north", "e * 104729 % 2003 - 1001 AS east",
        ).selectExpr(
            "concat('G-', number) AS event_id", "event_time",
            "concat('R', CAST(place AS STRING)) AS region_id",
            f"element_at(array({', '.join(repr(region[1]) for region in REGIONS)}), CAST(place AS INT)) AS region_name",
            f"({_centre('place', 2)} + IF(ob, 10000 + north * 4, north * 60)) / 1e6D"
            " + IF(bad = 0, 100.0D, 0.0D) AS latitude",
            f"({_centre('place', 3)} + IF(ob, 10000 + east * 4, east * 60)) / 1e6D AS longitude",
            "IF(bad = 3, NULL, event_type) AS symptom_category",
            "CAST(IF(bad = 2, 9, 1 + e * 13 % 4) AS INT) AS severity",
            "CAST(IF(bad = 1, 0, 1 + e * 17 % 3) AS INT) AS case_count",
            "ts AS created_at", "processed_at", "e % 50 = 0 AS _twice")
        return _with_replays(rows)

    def readings_of(self, *columns: str, where=None) -> DataFrame:
        """Stored readings: valid, first copy, with the fixed flag standing in for a model.

        Only the named columns (and the key) go through the shuffle that drops copies. ``where`` is applied
        before that shuffle; it may use whatever the copies of an event share, such as its time and region.
        """
        rows = valid_readings(self.raw_readings).withColumnRenamed("region_id", "region").withColumns({
            "predicted_anomaly": fixed_flag(),
            "latency_seconds": latency_seconds(F.col("created_at"), F.col("processed_at"))})
        return _first(rows if where is None else rows.filter(where), columns)

    def reports_of(self, *columns: str, where=None) -> DataFrame:
        """Stored reports: valid, first copy, renamed; see ``readings_of``."""
        rows = valid_reports(self.raw_reports).drop("region_name").withColumnsRenamed(
            {"region_id": "region", "symptom_category": "symptom_type"}).withColumn(
            "latency_seconds", latency_seconds(F.col("created_at"), F.col("processed_at")))
        return _first(rows if where is None else rows.filter(where), columns)

    @property
    def readings(self) -> DataFrame:
        return self.readings_of()

    @property
    def reports(self) -> DataFrame:
        return self.reports_of()

    @property
    def reading_labels(self) -> DataFrame:
        return self.events.selectExpr(
            "concat('V-', number) AS event_id", "e % 37 = 0 AS is_anomaly",
            f"IF(e % 37 = 0, {_pick(PATTERN_NAMES, 'e div 37 % 5')}, 'none') AS anomaly_type",
            "e % 101 = 5 AS is_corrupt",
            f"IF(e % 101 = 5, {_pick(CORRUPTION_NAMES, 'e div 101 % 4')}, 'none') AS corruption_type")

    @property
    def report_labels(self) -> DataFrame:
        return self.events.selectExpr(
            "concat('G-', number) AS event_id", "ob AS is_outbreak_event",
            f"IF(ob, {_outbreak_id('hr div 5', 'e % 2')}, NULL) AS outbreak_id")

    @property
    def outbreaks(self) -> DataFrame:
        """Two outbreaks per five hours, for the hours the events span."""
        return (
            self.events.agg(F.max("hr").alias("last"), F.min("ts").alias("ts"))
            .selectExpr("CAST(date_trunc('month', ts) AS TIMESTAMP_NTZ) AS start",
                        "explode(sequence(0, CAST(last div 5 AS INT))) AS fifth")
            .selectExpr("start", "fifth", "explode(array(0, 1)) AS parity")
            .selectExpr("*", "(fifth + 3 * parity) % 6 + 1 AS place")
            .selectExpr(
                f"{_outbreak_id('fifth', 'parity')} AS outbreak_id",
                f"({_centre('place', 2)} + 10000) / 1e6D AS center_latitude",
                f"({_centre('place', 3)} + 10000) / 1e6D AS center_longitude", "1.0D AS radius_km",
                "timestampadd(HOUR, fifth * 5 + 1, start) AS start_time",
                "timestampadd(HOUR, fifth * 5 + 3, start) AS end_time")
        )


# Label names in the order of their numbers.
PATTERN_NAMES = ["tachycardia_hypoxia", "fever", "hypotension", "hypertensive_crisis", "bradycardia"]
CORRUPTION_NAMES = ["missing_heart_rate", "impossible_oxygen", "diastolic_above_systolic",
                    "negative_respiratory_rate"]


# A three-tree forest as leaf boxes (tree, {feature: (low, high)}, path length).
FIXED_FOREST = [
    (0, {"heart_rate": (100, None)}, 1),
    (0, {"heart_rate": (None, 100), "oxygen_saturation": (None, 92)}, 2),
    (0, {"heart_rate": (None, 100), "oxygen_saturation": (92, None)}, 10),
    (1, {"body_temperature": (38.5, None)}, 1),
    (1, {"body_temperature": (None, 38.5), "systolic_bp": (160, None)}, 2),
    (1, {"body_temperature": (None, 38.5), "systolic_bp": (None, 160)}, 10),
    (2, {"diastolic_bp": (100, None)}, 1),
    (2, {"diastolic_bp": (None, 100), "respiratory_rate": (20, None)}, 2),
    (2, {"diastolic_bp": (None, 100), "respiratory_rate": (None, 20), "heart_rate": (None, 40)}, 3),
    (2, {"diastolic_bp": (None, 100), "respiratory_rate": (None, 20), "heart_rate": (40, None)}, 10),
]
FIXED_FOREST_NORM, FIXED_FOREST_THRESHOLD = 10.2448, 0.6


def fixed_flag() -> Column:
    """Stands in for a trained model where results are checked by SQL."""
    return F.expr("heart_rate >= 100 OR oxygen_saturation <= 90 OR body_temperature >= 38.5D"
                  " OR systolic_bp >= 160 OR (diastolic_bp = 84 AND respiratory_rate = 19)")


def _centre(number: str, position: int) -> str:
    """Latitude (position 2) or longitude (3) of a region centre in millionths of a degree."""
    values = ", ".join(str(round(region[position] * 1_000_000)) for region in REGIONS)
    return f"element_at(array({values}), CAST({number} AS INT))"


def _pick(names: list[str], number: str) -> str:
    return f"element_at(array({', '.join(map(repr, names))}), CAST({number} + 1 AS INT))"


def _outbreak_id(fifth: str, parity: str) -> str:
    return f"concat('OB-', lpad(CAST(CAST(2 * ({fifth}) + {parity} AS INT) AS STRING), 3, '0'))"


def _first(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    if columns:
        rows = rows.select(*dict.fromkeys(("event_id", "created_at", *columns)))
    return first_copy(rows)


def _with_replays(rows: DataFrame) -> DataFrame:
    """Some rows arrive a second time, a minute later."""
    names = [name for name in rows.columns if name != "_twice"]
    first = F.struct(*names)
    minute = F.expr("INTERVAL 1 MINUTE")
    again = F.struct(*[(F.col(n) + minute).alias(n) if n in ("created_at", "processed_at") else F.col(n)
                       for n in names])
    return rows.select(F.inline(F.when(F.col("_twice"), F.array(first, again)).otherwise(F.array(first))))
