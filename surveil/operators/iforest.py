"""Isolation Forest (Liu, Ting, Zhou, ICDM 2008) trained and applied on Spark.

The key and the six features are staged once. Of them a fixed number of rows per tree is drawn by
hash of the key, and all trees grow together, level by level: windows over (tree, node) give the
ranges a split is drawn from, and as the drawn rows are dealt out by tree, no level shuffles.
Every draw is an MD5 of (seed, tree, node or key), so a model can be repeated anywhere, in SQL
too. Splits are in the units of the readings: scaling does not change which trees there are.
The model is a table of tree nodes whose size depends on its parameters only (trees x 2^depth),
so it can be sent to every task. Training rows are scored once, for threshold and flags alike.
"""

import time
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveil.constants import FOREST_CONTAMINATION, FOREST_SEED, FOREST_TREES, VITALS
from surveil.operators.quantiles import exact_quantiles
from surveil.operators.validate import without_labels
from surveil.session import stage

SAMPLE_ROWS = 256   # rows per tree by default, as in the paper of the method
NODE_SCHEMA = "tree int, node int, feature int, split double, path_len double"
_EULER = 0.5772156649


def average_path(rows: float) -> float:
    """Expected path length of an unsuccessful search among ``rows`` values."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (np.log(rows - 1.0) + _EULER) - 2.0 * (rows - 1.0) / rows


@dataclass
class Forest:
    """Scaler, node table, sample size and the score above which a row is flagged."""

    means: list[float]
    deviations: list[float]
    nodes: DataFrame
    sample_rows: int
    depth: int
    threshold: float = 0.0


def feature_stats(readings: DataFrame) -> DataFrame:
    """One row: number of rows, and mean and population deviation per feature."""
    return readings.agg(F.count("*").alias("n"), *[F.avg(v).alias(f"avg_{v}") for v in VITALS],
                        *[F.stddev_pop(v).alias(f"sd_{v}") for v in VITALS])


def _scaled(means: list[float], deviations: list[float]) -> list:
    return [F.expr(f"({name} - {mean!r}D) / {(sd or 1.0)!r}D").alias(f"z_{name}")
            for name, mean, sd in zip(VITALS, means, deviations)]


def scale_vitals(readings: DataFrame, keys: list[str]) -> DataFrame:
    """Features with mean 0 and population deviation 1 (a constant feature becomes 0)."""
    stats = feature_stats(readings).first()
    return readings.select(*keys, *_scaled([stats[f"avg_{v}"] or 0.0 for v in VITALS],
                                           [stats[f"sd_{v}"] for v in VITALS]))


def _hash(*parts):
    """52 bits of the MD5 of the parts, joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[F.lit(p) if isinstance(p, (str, int)) else p.cast("string") for p in parts])), 1, 13), 16, 10).cast("long")


def _unit(*parts):
    """A number in [0, 1)."""
    return _hash(*parts).cast("double") / F.lit(float(1 << 52))


def _draw(readings: DataFrame, rows: int, sample: int, trees: int, seed: int, key: str) -> DataFrame:
    """(tree, key, features): ``sample`` rows of each tree, or all where there are fewer.

    One rule for any number of rows: every row is offered ``3 * sample * trees / rows`` times, each
    time to a tree drawn by hash; below one offer, a row is offered with that probability. Of the
    rows offered to a tree the first by hash stay.
    """
    offers = 3.0 * sample * trees / rows
    times = F.floor(F.lit(offers)).cast("int") + (_unit(seed, F.col(key), "offer") < offers - np.floor(offers)).cast("int")
    offered = readings.withColumn("_times", times).filter("_times > 0").withColumn("_offer", F.explode(F.sequence(F.lit(1), F.col("_times")))).withColumn(
        "tree", (_hash(seed, F.col(key), F.col("_offer")) % trees).cast("int")).drop("_offer", "_times").dropDuplicates(["tree", key])
    first = Window.partitionBy("tree").orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(key), F.col("tree"), F.lit("order"))), key)
    return offered.withColumn("_place", F.row_number().over(first)).filter(F.col("_place") <= sample).drop("_place")


def _path_column(rows):
    """``average_path`` of a column."""
    return F.when(rows <= 1, 0.0).when(rows == 2, 1.0).otherwise(2.0 * (F.log(rows - 1.0) + _EULER) - 2.0 * (rows - 1.0) / rows)


def _grow(drawn: DataFrame, depth: int, seed: int) -> DataFrame:
    """The nodes of all trees; ``drawn`` is dealt out by tree, and stays so."""
    here = Window.partitionBy("tree", "node")
    lows, highs = [f"_low{i}" for i in range(len(VITALS))], [f"_high{i}" for i in range(len(VITALS))]
    state = drawn.select("tree", *[F.col(v).cast("double").alias(v) for v in VITALS], F.lit(0).alias("node"), F.lit(True).alias("_grows"),
                         F.lit(None).cast("array<struct<node:int,feature:int,split:double,path_len:double>>").alias("_trail"))
    for level in range(depth + 1):
        state = state.withColumns({"_n": F.count("*").over(here), **{n: F.min(v).over(here) for n, v in zip(lows, VITALS)},
                                   **{n: F.max(v).over(here) for n, v in zip(highs, VITALS)}})
        varying = F.array_compact(F.array(*[F.when(F.col(h) > F.col(low), i) for i, (low, h) in enumerate(zip(lows, highs))]))
        state = state.withColumn("_varying", varying)
        ends = (F.col("_n") <= 1) | (F.size("_varying") == 0) if level < depth else F.lit(True)
        drawn_feature = F.element_at("_varying", (_hash(seed, F.col("tree"), F.col("node"), "feature") % F.size("_varying")).cast("int") + 1)
        state = state.withColumn("_feature", F.when(ends, -1).otherwise(drawn_feature))
        state = state.withColumns({name: F.when(F.col("_feature") >= 0, F.element_at(F.array(*of), F.col("_feature") + 1))
                                   for name, of in (("_low", lows), ("_high", highs), ("_value", VITALS))})
        state = state.withColumn("_split", F.col("_low") + _unit(seed, F.col("tree"), F.col("node"), "split") * (F.col("_high") - F.col("_low")))
        state = state.withColumn("_split", F.when(F.col("_split") >= F.col("_high"), F.col("_low")).otherwise(F.col("_split")))
        node = F.struct("node", F.col("_feature").alias("feature"), F.col("_split").alias("split"),
                        F.when(F.col("_feature") < 0, F.lit(float(level)) + _path_column(F.col("_n"))).alias("path_len"))
        trail = F.concat(F.coalesce("_trail", F.array().cast(state.schema["_trail"].dataType)), F.array(node))
        on = F.col("_grows") & (F.col("_feature") >= 0)
        state = state.select("tree", *VITALS, F.when(on, 2 * F.col("node") + F.when(F.col("_value") > F.col("_split"), 2).otherwise(1)).otherwise(F.col("node")).alias("node"),
                             on.alias("_grows"), F.when(F.col("_grows"), trail).otherwise(F.col("_trail")).alias("_trail"))
    return state.select("tree", F.explode("_trail").alias("x")).select("tree", "x.*").distinct()


def train(readings: DataFrame, trees: int = FOREST_TREES, contamination: float = FOREST_CONTAMINATION,
          seed: int = FOREST_SEED, key: str = "event_id", sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Train on the vital signs alone; the same data, seed and keys give the same model.

    ``sample_rows`` is the algorithm's own parameter: each tree isolates a sample of that many
    rows. Scaling and the threshold use every row.
    """
    return _trained(readings, trees, contamination, seed, key, sample_rows)[0]


def train_and_flag(readings: DataFrame, key: str = "event_id", **options) -> tuple[Forest, DataFrame]:
    """The forest, and (key, anomaly_score, predicted_anomaly) of the rows it was trained on, which are scored only once."""
    forest, scores = _trained(readings, key=key, **options)
    return forest, _flagged(scores, F.col("_score"), forest.threshold).drop("_score")


def _trained(readings: DataFrame, trees: int = FOREST_TREES, contamination: float = FOREST_CONTAMINATION,
             seed: int = FOREST_SEED, key: str = "event_id", sample_rows: int = SAMPLE_ROWS) -> tuple[Forest, DataFrame]:
    without_labels(readings)
    readings = stage(readings.select(key, *VITALS), "forest-rows")
    stats = feature_stats(readings).first()
    if not stats["n"]:
        raise ValueError("No readings to train on.")
    means = [stats[f"avg_{v}"] for v in VITALS]
    deviations = [stats[f"sd_{v}"] for v in VITALS]
    sample = min(sample_rows, stats["n"])
    depth = max(1, int(np.ceil(np.log2(max(sample, 2)))))
    drawn = _draw(readings, stats["n"], sample_rows, trees, seed, key)
    nodes = stage(_grow(drawn, depth, seed).select(*[x.split()[0] for x in NODE_SCHEMA.split(", ")]), "forest")
    forest = Forest(means, deviations, nodes, sample, depth)
    scores = stage(readings.select(key, _score(forest).alias("_score")), "forest-scores")
    forest.threshold = exact_quantiles(scores, [], "_score", {"t": 1 - contamination}).first()["t"]
    return forest, scores


def _score(forest: Forest):
    """Column with the score 2^(-E[path] / c(sample)), rounded to millionths.

    Trees are laid out as complete binary trees, so a batch walks all of them level by level.
    """
    table = forest.nodes.toPandas()   # at most trees x 2^(depth + 1) rows, a model parameter
    trees = int(table["tree"].max()) + 1
    inner, leaves = 2 ** forest.depth - 1, 2 ** forest.depth
    feature = np.zeros((trees, inner), dtype=np.int64)
    split = np.full((trees, inner), np.inf)
    path = np.zeros((trees, leaves))
    branches = table[table["feature"] >= 0]
    feature[branches["tree"], branches["node"]] = branches["feature"]
    split[branches["tree"], branches["node"]] = branches["split"]
    ends = table[table["feature"] < 0]
    node = ends["node"].to_numpy().copy()
    while (node < inner).any():           # a leaf above the last level is reached by going left
        node = np.where(node < inner, 2 * node + 1, node)
    path[ends["tree"], node - inner] = ends["path_len"]
    norm, depth, width = average_path(forest.sample_rows) or 1.0, forest.depth, len(VITALS)

    @F.pandas_udf("double")
    def score(frame: pd.DataFrame) -> pd.Series:
        values = frame.to_numpy(dtype=float)
        flat, start = values.ravel(), np.arange(len(values)) * width
        total = np.zeros(len(values))
        for tree in range(trees):
            at = np.zeros(len(values), dtype=np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (flat[start + feature[tree][at]] > split[tree][at])
            total += path[tree][at - inner]
        return pd.Series(np.round(2.0 ** (-total / trees / norm), 6))

    return score(F.struct(*VITALS))


def score(forest: Forest, readings: DataFrame) -> DataFrame:
    """Adds ``anomaly_score`` (higher = stranger) and ``predicted_anomaly`` (score above 0)."""
    without_labels(readings)
    return _flagged(readings, _score(forest), forest.threshold)


def _flagged(rows: DataFrame, value, threshold: float) -> DataFrame:
    """Flagged by the exact difference from the threshold, shown with six decimals."""
    exact = rows.withColumn("anomaly_score", value - F.lit(threshold))
    return exact.withColumn("predicted_anomaly", F.col("anomaly_score") > 0).withColumn("anomaly_score", F.bround("anomaly_score", 6))


def score_boxes(readings: DataFrame, boxes: list[tuple[int, dict, float]], norm: float,
                threshold: float) -> DataFrame:
    """Score a forest given as leaf boxes ``(tree, {feature: (low, high)}, path_len)``.

    Bounds are inclusive below and exclusive above; None is open. Small forests stay native.
    """
    paths = {}
    for tree, bounds, path_len in boxes:
        tests = [f"{name} >= {low}" for name, (low, _) in bounds.items() if low is not None]
        tests += [f"{name} < {high}" for name, (_, high) in bounds.items() if high is not None]
        paths.setdefault(tree, []).append(f"WHEN {' AND '.join(tests)} THEN {float(path_len)}D")
    total = " + ".join(f"CASE {' '.join(cases)} END" for cases in paths.values())
    return readings.withColumn("anomaly_score", F.expr(
        f"pow(2.0D, -(({total}) / {len(paths)}) / {norm!r}D) - {threshold!r}D")).withColumn(
        "predicted_anomaly", F.col("anomaly_score") > 0)


def save(forest: Forest, path: str) -> None:
    """Add a version of the model under ``path``; versions already there are not touched.

    A version counts once its summary is committed, and that is written last, so a reader gets
    trees and threshold of the same model, the old one or the new one.
    """
    spark = forest.nodes.sparkSession
    version = f"{path}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    forest.nodes.coalesce(1).write.parquet(f"{version}/nodes")
    row = (forest.means, [float(sd or 0.0) for sd in forest.deviations], forest.sample_rows, forest.depth,
           float(forest.threshold))
    spark.createDataFrame([row], "means array<double>, deviations array<double>, sample_rows int,"
                                 " depth int, threshold double").coalesce(1).write.parquet(f"{version}/summary")


def load(spark: SparkSession, path: str) -> Forest:
    """The newest complete version of the model under ``path``."""
    files = spark._jvm.org.apache.hadoop.fs
    done = files.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(files.Path(f"{path}/*/summary/_SUCCESS"))
    versions = sorted(status.getPath().getParent().getParent().toString() for status in done or [])
    if not versions:
        raise FileNotFoundError(f"No model at {path}; train one and save it there first.")
    row = spark.read.parquet(f"{versions[-1]}/summary").first()
    return Forest(list(row["means"]), list(row["deviations"]), spark.read.schema(NODE_SCHEMA).parquet(
        f"{versions[-1]}/nodes"), row["sample_rows"], row["depth"], row["threshold"])
