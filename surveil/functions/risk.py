"""The risk heuristic: half from the anomaly rate, half from clustered cases."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveil.constants import RISK_FULL_ANOMALY_RATE, RISK_FULL_CASES, RISK_HIGH, RISK_MEDIUM


def risk_level(score: Column) -> Column:
    return F.when(score >= RISK_HIGH, "High").when(score >= RISK_MEDIUM, "Medium").otherwise("Low")


def risk_columns(rate: Column, cases: Column) -> dict[str, Column]:
    """Columns of the score; the rate goes in unrounded."""
    anomaly = F.least(rate / F.lit(RISK_FULL_ANOMALY_RATE), F.lit(1.0))
    cluster = F.least(cases / F.lit(float(RISK_FULL_CASES)), F.lit(1.0))
    score = F.bround(100 * (0.5 * anomaly + 0.5 * cluster), 2)
    return {
        "anomaly_part": F.bround(anomaly, 4),
        "cluster_part": F.bround(cluster, 4),
        "risk_score": score,
        "risk_level": risk_level(score),
    }
