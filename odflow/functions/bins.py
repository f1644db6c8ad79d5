"""Five-minute departure bins and service days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BIN_MINUTES = 5
BINS_PER_DAY = 24 * 60 // BIN_MINUTES

# (first day, day after the last)
DayRange = tuple[date, date]


def _midnight(day: date) -> Column:
    # From text: a datetime literal is an instant, which the session time zone would move.
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")


def in_days(moment: Column, days: list[DayRange]) -> Column:
    """True from the first midnight of a range up to, not including, its last one."""
    hit = F.lit(False)
    for first, after in days:
        hit = hit | ((moment >= _midnight(first)) & (moment < _midnight(after)))
    return hit


def bin_of(moment: Column) -> Column:
    """Start of the half-open five-minute bin that holds ``moment``."""
    return F.window(moment, f"{BIN_MINUTES} minutes")["start"]


def step_of_day(bin_start: Column) -> Column:
    """Number of the bin within its day, 0 to 287."""
    minutes = (F.hour(bin_start) * 60 + F.minute(bin_start)).cast("long")
    return F.call_function("div", minutes, F.lit(BIN_MINUTES))


def bin_starts(days: list[DayRange]) -> Column:
    """All bin starts of the ranges as one array; 288 a day, whatever the clocks do.

    Bins are counted off from midnight: a sequence of timestamps would follow the session
    time zone and skip an hour when clocks change.
    """
    def run(first: date, after: date) -> Column:
        count = (after - first).days * BINS_PER_DAY
        steps = F.sequence(F.lit(0), F.lit(count - 1))
        return F.transform(steps, lambda step: _midnight(first) + F.make_dt_interval(mins=step * BIN_MINUTES))

    return F.concat(*[run(first, after) for first, after in days if after > first])


def bins_of(spark: SparkSession, days: list[DayRange]) -> DataFrame:
    """One row per bin: (service_date, bin_start)."""
    bins = spark.range(1).select(F.explode(bin_starts(days)).alias("bin_start"))
    return bins.select(F.to_date("bin_start").alias("service_date"), "bin_start")
