"""Joins that stay balanced when one key holds a large share of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_SALT = 200_000


def hot_keys(sizes: DataFrame, keys: list[str], size: str,
             rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Every key with more rows than one task should take, and the number of parts it is split into."""
    return sizes.filter(F.col(size) > rows_per_salt).select(
        *keys, F.ceil(F.col(size) / rows_per_salt).cast("int").alias("_parts"))


def salted_join(rows: DataFrame, few: DataFrame, keys: list[str], hot: DataFrame | None,
                spread: str, how: str = "inner") -> DataFrame:
    """Inner or left join of ``rows`` (skewed on ``keys``) with ``few`` (few rows per key).

    Rows of a hot key are spread over its parts by a hash of ``spread``; the matching rows of
    ``few`` are repeated once per part. Other keys join as they are, and so do all when the
    caller has measured that no key is hot (``hot`` is None).
    """
    if hot is None:
        return rows.join(few, keys, how)
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    left = (rows.join(hot, keys, "left")
            .withColumn("_part", F.pmod(F.xxhash64(spread), parts).cast("int")).drop("_parts"))
    right = (few.join(hot, keys, "left")
             .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts"))
    return left.join(right, [*keys, "_part"], how).drop("_part")
