"""Both detectors against labels they never saw."""

from pyspark.sql import DataFrame

from surveil.operators import iforest
from surveil.operators.evaluate import confusion_metrics, label_join
from surveil.operators.rolling import verdicts_on_arrival


def causal_flags(reports: DataFrame, minutes: int = 60) -> DataFrame:
    """(event_id, event_time, predicted_outbreak): was an event in a cluster when it arrived?

    At every arrival time the reports of the last ``minutes`` count, and only the events that
    arrive then get a verdict, as a live run would have had it.
    """
    return verdicts_on_arrival(reports, minutes).withColumnRenamed("in_cluster", "predicted_outbreak")


def evaluate_clusters(reports: DataFrame, labels: DataFrame) -> DataFrame:
    results = label_join(causal_flags(reports), labels)
    return confusion_metrics(results, "is_outbreak_event", "predicted_outbreak")


def evaluate_flags(readings: DataFrame, labels: DataFrame) -> DataFrame:
    results = label_join(readings.select("event_id", "predicted_anomaly"), labels)
    return confusion_metrics(results, "is_anomaly", "predicted_anomaly")


def evaluate_forest(train: DataFrame, held_out: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on one part, score the other, compare with the labels of the other."""
    forest = iforest.train(train)
    return evaluate_flags(iforest.score(forest, held_out), labels)
