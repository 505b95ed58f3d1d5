"""Trend forecasts for many series at once."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.constants import BIN_MINUTES, FORECAST_BAND_Z, FORECAST_MIN_BINS, FORECAST_STEPS
from surveil.functions.display import non_negative

_COLUMNS = ["kind", "name", "forecast_time", "predicted_cases", "lower_cases", "upper_cases", "history_points"]


def _rows(predicted: DataFrame, minutes: int) -> DataFrame:
    """(kind, name, last_bin, step, value, sd, n) -> forecast rows, never below 0."""
    band = F.lit(FORECAST_BAND_Z) * F.col("sd")
    return predicted.select(
        "kind", "name",
        F.expr(f"timestampadd(MINUTE, step * {minutes}, last_bin)").alias("forecast_time"),
        non_negative(F.col("value")).alias("predicted_cases"),
        non_negative(F.col("value") - band).alias("lower_cases"),
        non_negative(F.col("value") + band).alias("upper_cases"),
        F.col("n").cast("long").alias("history_points"))


def trend_forecast(history: DataFrame, steps: int = FORECAST_STEPS, minimum: int = FORECAST_MIN_BINS,
                   minutes: int = BIN_MINUTES) -> DataFrame:
    """Straight-line trend per series with an 80 % band, starting after the last complete bin."""
    fits = history.groupBy("kind", "name").agg(
        F.count("*").alias("n"), F.max("ds").alias("last_bin"), F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"), F.regr_syy("y", "x").alias("syy"),
        F.regr_sxx("y", "x").alias("sxx"), F.regr_sxy("y", "x").alias("sxy"),
    ).filter(F.col("n") >= minimum)
    return _rows(fits.selectExpr(
        "*", "sqrt(greatest(syy - sxy * sxy / sxx, 0.0D) / (n - 2)) AS sd", f"explode(sequence(1, {steps})) AS step",
    ).withColumn("value", F.expr("intercept + slope * (n - 1 + step)")), minutes)


def piecewise_forecast(history: DataFrame, steps: int = FORECAST_STEPS, minimum: int = FORECAST_MIN_BINS,
                       minutes: int = BIN_MINUTES, changepoints: int = 25, shrink: float = 20.0) -> DataFrame:
    """Trend that may bend at evenly spaced points of the first 80 % of a series.

    The bends are shrunk towards 0 (Taylor & Letham, "Forecasting at scale", 2018). A group
    is one series: its size is the number of bins, not of reports.
    """
    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("x")
        y, n = frame["y"].to_numpy(dtype=float), len(frame)
        if n < minimum:
            return pd.DataFrame(columns=["kind", "name", "last_bin", "step", "value", "sd", "n"])
        t = np.arange(n + steps) / (n - 1)
        bends = np.linspace(0, 0.8, min(changepoints, n // 3) + 1)[1:]
        basis = np.column_stack([np.ones_like(t), t, np.maximum(t[:, None] - bends[None, :], 0.0)])
        weight = np.diag([0.0, 0.0] + [shrink] * len(bends))
        past = basis[:n]
        beta = np.linalg.solve(past.T @ past + weight, past.T @ y)
        sd = float(np.sqrt(((y - past @ beta) ** 2).sum() / max(n - 2, 1)))
        return pd.DataFrame({
            "kind": frame["kind"].iloc[0], "name": frame["name"].iloc[0], "last_bin": frame["ds"].iloc[-1],
            "step": np.arange(1, steps + 1), "value": basis[n:] @ beta, "sd": sd, "n": n})

    time = history.schema["ds"].dataType.simpleString()
    fitted = history.groupBy("kind", "name").applyInPandas(
        fit, f"kind string, name string, last_bin {time}, step int, value double, sd double, n bigint")
    return _rows(fitted, minutes)
