"""Record validation: keep, count, or explain what fails."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from surveil.constants import (
    PATTERNS, PULSE_PRESSURE_MIN, READING_REQUIRED, REPORT_REQUIRED, SEVERITY_RANGE,
    TRUTH_COLUMNS, VITAL_RANGES, VITALS,
)

_DOUBLES = {"oxygen_saturation", "body_temperature", "latitude", "longitude"}


def _missing(column: str) -> Column:
    value = F.col(column)
    return value.isNull() | F.isnan(value) if column in _DOUBLES else value.isNull()


def reading_rules() -> list[tuple[str, Column]]:
    """(reason, failing predicate) in the order they are checked."""
    rules = [(f"missing_{name}", _missing(name)) for name in READING_REQUIRED]
    rules += [(f"{name}_out_of_range", ~F.col(name).between(low, high))
              for name, (low, high) in VITAL_RANGES.items()]
    rules.append(("systolic_not_above_diastolic", F.col("systolic_bp") <= F.col("diastolic_bp")))
    return rules


def report_rules() -> list[tuple[str, Column]]:
    low, high = SEVERITY_RANGE
    rules = [(f"missing_{name}", _missing(name)) for name in REPORT_REQUIRED]
    rules += [
        ("latitude_out_of_range", ~F.col("latitude").between(-90, 90)),
        ("longitude_out_of_range", ~F.col("longitude").between(-180, 180)),
        ("case_count_below_one", F.col("case_count") < 1),
        ("severity_out_of_range", ~F.col("severity").between(low, high)),
    ]
    return rules


def reject_reason(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first failing rule, NULL for a valid record."""
    return F.coalesce(*[F.when(failing, F.lit(reason)) for reason, failing in rules])


def passing(records: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """The records that fail no rule; a rule that cannot be decided (NULL) counts as failed."""
    return records.filter(reduce(Column.__and__, [~failing for _, failing in rules]))


def valid_readings(readings: DataFrame) -> DataFrame:
    return passing(readings, reading_rules())


def valid_reports(reports: DataFrame) -> DataFrame:
    return passing(reports, report_rules())


def with_reason(records: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    return records.withColumn("reject_reason", reject_reason(rules))


def quarantine(records: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Only the rejected records, each with its reason."""
    return with_reason(records, rules).filter(F.col("reject_reason").isNotNull())


def reject_counts(records: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Rows read, rejected and kept, in one pass."""
    rejected = reject_reason(rules).isNotNull()
    return records.agg(
        F.count("*").alias("rows_read"),
        F.count_if(rejected).alias("rows_rejected"),
        F.count_if(~rejected).alias("rows_valid"))


def label_columns(schema: StructType, labels: frozenset[str] | set[str] = TRUTH_COLUMNS) -> list[str]:
    """Names in ``schema``, at any depth and in any case, that only labels may carry."""
    wanted = {name.lower() for name in labels}
    found = []
    for field in schema.fields:
        found += [field.name] if field.name.lower() in wanted else []
        inner = field.dataType.elementType if isinstance(field.dataType, ArrayType) else field.dataType
        found += label_columns(inner, labels) if isinstance(inner, StructType) else []
    return found


def without_labels(frame: DataFrame) -> DataFrame:
    """``frame`` itself, if nothing in it can tell a detector the answer."""
    if leaked := label_columns(frame.schema):
        raise ValueError(f"a detector was given label columns: {', '.join(leaked)}")
    return frame


def normalise_vitals(readings: DataFrame) -> DataFrame:
    """Values as a monitor reports them; diastolic stays below systolic."""
    whole = [name for name in VITALS if name not in _DOUBLES]
    rounded = {name: F.bround(F.col(name), 0).cast("int") for name in whole}
    rounded |= {name: F.bround(F.col(name), 1) for name in VITALS if name in _DOUBLES}
    rounded["diastolic_bp"] = F.least(rounded["diastolic_bp"],
                                      rounded["systolic_bp"] - PULSE_PRESSURE_MIN)
    return readings.withColumns(rounded)


def pattern_tags(readings: DataFrame, keys: list[str]) -> DataFrame:
    """One row per reading and named pattern whose bounds it meets on every listed vital."""
    tags = F.array_compact(F.array(*[
        F.when(reduce(Column.__and__, [F.col(v).between(lo, hi) for v, (lo, hi) in bounds.items()]),
               F.lit(name))
        for name, bounds in PATTERNS.items()]))
    return readings.select(*keys, F.explode(tags).alias("pattern"))
