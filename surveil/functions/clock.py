"""Time functions for the simulated clock, windows and latency."""

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveil.constants import CLUSTER_WINDOW_MINUTES, TICK_MINUTES


def utc(time: datetime) -> Column:
    """A literal time; one without a zone is UTC, whatever the zone of the Python process."""
    aware = time.replace(tzinfo=timezone.utc) if time.tzinfo is None else time.astimezone(timezone.utc)
    return F.lit(aware.isoformat(timespec="microseconds")).cast("timestamp")


def floor_to(time: Column, minutes: int) -> Column:
    """Start of the fixed bin a time falls in; bins are aligned to midnight UTC."""
    return F.window(time, f"{minutes} minutes").start


def window_end(time: Column, minutes: int = CLUSTER_WINDOW_MINUTES,
               slide: int | None = None) -> Column:
    """End of each window ``(end - minutes, end]`` that holds ``time``.

    Spark windows are closed on the left; moving the time back by its smallest step
    turns them into left-open, right-closed ones.
    """
    shifted = time - F.expr("INTERVAL 1 MICROSECOND")
    if slide is None or slide == minutes:
        return F.window(shifted, f"{minutes} minutes").end
    return F.window(shifted, f"{minutes} minutes", f"{slide} minutes").end


def utc_text(time: Column) -> Column:
    """ISO text in UTC with milliseconds; sorts like the time itself."""
    return F.concat(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+00:00"))


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def latency_seconds(created: Column, processed: Column) -> Column:
    return F.bround(seconds_between(created, processed), 3)


def tick_of(time: Column, start: Column, minutes: int = TICK_MINUTES) -> Column:
    """Number of whole ticks between ``start`` and ``time``."""
    return F.floor(F.timestamp_diff("MICROSECOND", start, time) / F.lit(minutes * 60_000_000.0))


def tick_time(tick: Column, start: Column, minutes: int = TICK_MINUTES) -> Column:
    return start + F.make_dt_interval(mins=(tick * minutes).cast("int"))
