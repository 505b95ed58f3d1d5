"""Keyed writes as set operations: first copy wins, insert if absent, last assignment."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_copy(records: DataFrame, key: str = "event_id", order: str = "created_at") -> DataFrame:
    """One row per key, the earliest by ``order`` (then by content).

    An aggregate, not a ranking window: copies are reduced before the shuffle, so a key
    that holds a large share of the rows never gathers in one task.
    """
    rest = [name for name in records.columns if name not in (key, order)]
    kept = records.groupBy(key).agg(F.min(F.struct(order, *rest)).alias("_first"))
    return kept.select(*[
        F.col(key) if name == key else F.col("_first")[name].alias(name)
        for name in records.columns])


def insert_if_absent(batch: DataFrame, stored: DataFrame, key: str = "event_id",
                     order: str = "created_at") -> DataFrame:
    """The rows of ``batch`` a store with unique keys would accept."""
    return first_copy(batch, key, order).join(stored.select(key), key, "left_anti")


def latest_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the largest ``order`` per key."""
    rest = [name for name in rows.columns if name not in (key, order)]
    kept = rows.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("_last"))
    return kept.select(*[
        F.col(key) if name == key else F.col("_last")[name].alias(name)
        for name in rows.columns])


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)
