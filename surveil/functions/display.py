"""Values as reports show them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveil.constants import REGIONS


def region_name(region: Column) -> Column:
    """Name of a region from the fixed list; NULL for an unknown id."""
    chosen = F.lit(None).cast("string")
    for region_id, name, _, _ in reversed(REGIONS):
        chosen = F.when(region == region_id, F.lit(name)).otherwise(chosen)
    return chosen


def percent_text(share: Column) -> Column:
    return F.format_string("%.1f%%", 100 * share)


def non_negative(value: Column) -> Column:
    """Counts cannot be negative: clip at 0, two decimals."""
    return F.bround(F.greatest(value, F.lit(0.0)), 2)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def yes_no(flag: Column) -> Column:
    return F.when(flag, "Yes").when(~flag, "No")
