"""Exact quantiles from counts of distinct values, by refining the range that holds a rank.

Values are counted first. While a range that holds a wanted rank has more distinct values than one
task should order, it is cut at ``PARTS`` of its own quantiles (a sketch of bounded size decides where
to cut, exact counts decide which part holds the rank), so every round divides it by about ``PARTS``
however the values are spread. Only what is left is put in order. Planning a query therefore runs it.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveil.session import stage

PARTS = 64
ORDERED_VALUES = 100_000   # distinct values of one range that a task orders


def exact_quantiles(rows: DataFrame, by: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """One row per ``by`` with linearly interpolated quantiles of the non-null ``value``; no row for a group without values."""
    wanted_by, by = by, by or ["_every"]
    rows = rows if wanted_by else rows.withColumn("_every", F.lit(0))
    counts = stage(rows.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_value")).agg(F.count("*").alias("_count")), "counts")
    names = F.explode(F.array(*[F.struct(F.lit(name).alias("_name"), F.lit(float(q)).alias("_q")) for name, q in wanted.items()]))
    whole = counts.groupBy(*by).agg(F.min("_value").alias("_low"), F.max("_value").alias("_high"), F.sum("_count").alias("_all"), F.count("*").alias("_values"))
    ranges = whole.select(*by, "_low", "_high", "_all", "_values", F.lit(0).cast("long").alias("_before"), names.alias("_w")).select(
        *by, "_w._name", (F.col("_w._q") * (F.col("_all") - 1)).alias("_place"), "_low", "_high", "_before", "_values")
    ranges = stage(ranges, "ranges")
    key = [*by, "_name"]
    while ranges.filter(F.col("_values") > ORDERED_VALUES).limit(1).count():
        open_ranges = ranges.filter(F.col("_values") > ORDERED_VALUES)
        inside = counts.join(open_ranges, by).filter("_value BETWEEN _low AND _high")
        cuts = inside.groupBy(*key).agg(F.percentile_approx("_value", [i / PARTS for i in range(1, PARTS)], 16 * PARTS).alias("_cuts"))
        parts = inside.join(cuts, key).withColumn("_part", F.size(F.filter("_cuts", lambda c: c < F.col("_value")))).groupBy(*key, "_place", "_before", "_part").agg(
            F.min("_value").alias("_low"), F.max("_value").alias("_high"), F.sum("_count").alias("_held"), F.count("*").alias("_values"))
        along = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_held").over(along), F.lit(0)))
        held = parts.filter("_before <= ceil(_place) AND _before + _held > floor(_place)")
        finer = held.groupBy(*key, "_place").agg(F.min("_low").alias("_low"), F.max("_high").alias("_high"), F.min("_before").alias("_before"), F.sum("_values").alias("_values"))
        ranges = stage(finer.select(*ranges.columns).unionByName(ranges.filter(F.col("_values") <= ORDERED_VALUES)), "ranges")
    near = counts.join(ranges, by).filter("_value BETWEEN _low AND _high")
    upto = near.withColumn("_upto", F.col("_before") + F.sum("_count").over(Window.partitionBy(*key).orderBy("_value")))

    def at(rank: str):
        return F.min(F.expr(f"IF(_upto > {rank}, _value, NULL)"))

    found = upto.groupBy(*key).agg(at("floor(_place)").alias("_a"), at("ceil(_place)").alias("_b"), F.max(F.expr("_place - floor(_place)")).alias("_part"))
    found = found.select(*by, "_name", F.expr("_a + (_b - _a) * _part").alias("_found"))
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("_name") == name, F.col("_found"))).alias(name) for name in wanted]).select(*wanted_by, *wanted)
