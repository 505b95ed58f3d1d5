"""Comparison of verdicts with labels kept apart."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_audit(verdicts: DataFrame, labels: DataFrame, key: str = "event_id") -> DataFrame:
    """One row: matched, unmatched and repeated keys of both sides.

    Both sides are counted per key in one grouping; nothing is joined for it.
    """
    both = verdicts.select(key, F.lit(1).alias("v"), F.lit(0).alias("l")).unionByName(
        labels.select(key, F.lit(0).alias("v"), F.lit(1).alias("l")))
    keys = both.groupBy(key).agg(F.sum("v").alias("v"), F.sum("l").alias("l"))
    return keys.agg(
        F.count_if(F.expr("v > 0 AND l > 0")).alias("matched"),
        F.count_if(F.expr("v > 0 AND l = 0")).alias("without_label"),
        F.count_if(F.expr("v = 0 AND l > 0")).alias("without_verdict"),
        F.count_if(F.expr("v > 1 OR l > 1")).alias("repeated"))


def label_join(verdicts: DataFrame, labels: DataFrame, key: str = "event_id", strict: bool = True) -> DataFrame:
    """Verdicts with their labels.

    ``strict`` fails the query when a verdict has no label or a key repeats on either side; the
    check is part of the join, so nothing is read twice. Otherwise unmatched verdicts are left out.
    """
    if not strict:
        return verdicts.join(labels, key)

    def once(side: DataFrame, name: str) -> DataFrame:
        rest = [c for c in side.columns if c != key]
        return side.groupBy(key).agg(F.count("*").alias(f"_{name}s"), F.any_value(F.struct(*rest)).alias(f"_{name}"))

    both = once(verdicts, "verdict").join(once(labels, "label"), key, "left")
    wrong = F.expr("_verdicts > 1 OR coalesce(_labels, 0) <> 1")
    message = F.concat(F.lit("not one label per verdict: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    checked = both.withColumn("_ok", F.when(wrong, F.raise_error(message).cast("boolean")).otherwise(True)).filter("_ok")
    return checked.select(key, "_verdict.*", "_label.*")


def confusion_metrics(results: DataFrame, actual: str, predicted: str, by: list[str] = ()) -> DataFrame:
    """Confusion counts with precision, recall, F1 and false-positive rate (0 when undefined)."""
    def share(top: str, bottom: str, name: str):
        return F.expr(f"IF({bottom} = 0, 0.0D, bround(CAST({top} AS DOUBLE) / ({bottom}), 4)) AS {name}")

    counts = results.groupBy(*by).agg(
        F.count("*").alias("items"),
        F.count_if(F.expr(f"{actual} AND {predicted}")).alias("true_positives"),
        F.count_if(F.expr(f"NOT {actual} AND {predicted}")).alias("false_positives"),
        F.count_if(F.expr(f"{actual} AND NOT {predicted}")).alias("false_negatives"),
        F.count_if(F.expr(f"NOT {actual} AND NOT {predicted}")).alias("true_negatives"))
    return counts.select(
        *by, "items", "true_positives", "false_positives", "false_negatives", "true_negatives",
        share("true_positives", "true_positives + false_positives", "precision"),
        share("true_positives", "true_positives + false_negatives", "recall"),
        share("2 * true_positives", "2 * true_positives + false_positives + false_negatives", "f1"),
        share("false_positives", "false_positives + true_negatives", "false_positive_rate"),
        share("true_positives + false_negatives", "items", "prevalence"))


def recall_by_type(results: DataFrame, actual: str, predicted: str, kind: str) -> DataFrame:
    return results.filter(actual).groupBy(kind).agg(
        F.count("*").alias("items"), F.bround(F.avg(F.col(predicted).cast("double")), 3).alias("recall"))


def outbreaks_detected(results: DataFrame, outbreaks: DataFrame) -> DataFrame:
    """One row: outbreaks with at least one clustered event of their own, and all outbreaks."""
    hit = results.filter("predicted_outbreak AND is_outbreak_event").select("outbreak_id").distinct()
    return hit.select(F.lit(1).alias("d"), F.lit(0).alias("t")).unionByName(
        outbreaks.select(F.lit(0).alias("d"), F.lit(1).alias("t"))).agg(
        F.coalesce(F.sum("d"), F.lit(0)).alias("detected"), F.coalesce(F.sum("t"), F.lit(0)).alias("outbreaks"))
