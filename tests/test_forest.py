"""The distributed Isolation Forest: properties, not bits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog.fixtures import FIXED_FOREST, FIXED_FOREST_NORM, FIXED_FOREST_THRESHOLD, Feeds
from surveil.constants import VITALS
from surveil.operators import iforest


@pytest.fixture(scope="module")
def readings(spark):
    rows = Feeds(spark, "/root/testdata/sf0.01").readings.drop("predicted_anomaly")
    return spark.createDataFrame(rows.select("event_id", *VITALS).toPandas())


@pytest.fixture(scope="module")
def forest(readings):
    return iforest.train(readings)


def test_average_path():
    assert iforest.average_path(1) == 0 and iforest.average_path(2) == 1
    assert abs(iforest.average_path(256) - FIXED_FOREST_NORM) < 1e-3


def test_nodes_partition_each_sample(forest):
    nodes = forest.nodes.toPandas()
    assert nodes["tree"].nunique() == 200 and nodes["node"].max() < 2 ** (forest.depth + 1) - 1
    for _, tree in nodes[nodes["tree"] < 5].groupby("tree"):
        ids = set(tree["node"])
        for node, feature in zip(tree["node"], tree["feature"]):
            assert ({2 * node + 1, 2 * node + 2} <= ids) == (feature >= 0)


def test_share_of_flags_and_extremes(spark, readings, forest):
    scored = iforest.score(forest, readings)
    flagged = scored.filter("predicted_anomaly").count() / readings.count()
    assert abs(flagged - 0.03) < 0.005
    odd = spark.createDataFrame([("X", 190, 220, 140, 72.0, 41.5, 45)],
                                "event_id string, " + ", ".join(
                                    f"{v} {'double' if v in ('oxygen_saturation', 'body_temperature') else 'int'}" for v in VITALS))
    usual = scored.agg(F.max("anomaly_score")).first()[0]
    row = iforest.score(forest, odd).first()
    assert row["predicted_anomaly"] and row["anomaly_score"] >= usual


def test_same_data_same_model_whatever_the_partitions(readings, forest):
    again = iforest.train(readings.repartition(7, "heart_rate"))
    one = forest.nodes.orderBy("tree", "node").toPandas()
    two = again.nodes.orderBy("tree", "node").toPandas()
    assert one[["tree", "node", "feature"]].equals(two[["tree", "node", "feature"]])
    assert np.allclose(one["split"].dropna(), two["split"].dropna()) and abs(forest.threshold - again.threshold) < 1e-6


def test_small_inputs_use_every_row(readings):
    few = readings.orderBy("event_id").limit(50)
    forest = iforest.train(few, trees=20)
    assert forest.sample_rows == 50 and forest.nodes.select("tree").distinct().count() == 20


def test_saved_model_scores_the_same(spark, readings, forest, tmp_path):
    iforest.save(forest, str(tmp_path / "model"))
    loaded = iforest.load(spark, str(tmp_path / "model"))
    a = iforest.score(forest, readings).agg(F.sum("anomaly_score")).first()[0]
    b = iforest.score(loaded, readings).agg(F.sum("anomaly_score")).first()[0]
    assert a == b
    with pytest.raises(FileNotFoundError, match="No model"):
        iforest.load(spark, str(tmp_path / "nothing"))


def test_labels_are_refused(readings):
    with pytest.raises(ValueError, match="is_anomaly"):
        iforest.train(readings.withColumn("is_anomaly", F.lit(True)))


def test_recall_on_labelled_patterns(spark, readings, forest):
    labels = Feeds(spark, "/root/testdata/sf0.01").reading_labels
    hit = iforest.score(forest, readings).join(labels, "event_id").filter("is_anomaly").groupBy("anomaly_type").agg(
        F.avg(F.col("predicted_anomaly").cast("double")).alias("recall")).toPandas().set_index("anomaly_type")["recall"]
    assert hit["hypertensive_crisis"] > 0.9 and hit["tachycardia_hypoxia"] > 0.9


def test_boxes_meet_one_leaf_per_tree(readings):
    scored = iforest.score_boxes(readings, FIXED_FOREST, FIXED_FOREST_NORM, FIXED_FOREST_THRESHOLD)
    assert scored.filter("anomaly_score IS NULL").count() == 0 and scored.filter("predicted_anomaly").count() == 215
