"""Telecom activity per ten-minute slot: cleaning, hourly averages, peak hour, traffic.

The same functions serve batch and streaming DataFrames, except ``peak_hour``, which
needs a finished set of hours. All aggregates combine map-side, so an hour or square that
holds most of the rows costs one partial row per task.
"""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.functions.dates import epoch_to_time, slot_end
from ringledger.schemas import ACTIVITY_MEASURES

# Minutes per activity slot, width of the analysis window.
SLOT_MINUTES = 10
HOUR = "1 hour"


def fill_missing(raw: DataFrame) -> DataFrame:
    """Zero for every missing value of the eight positional columns."""
    return raw.fillna(0, [f"_c{i}" for i in range(3)]).fillna(
        0.0, [f"_c{i}" for i in range(3, 8)]
    )


def cleaned(raw: DataFrame, scale: int | None = None) -> DataFrame:
    """Named activity columns with slot begin and end, from the positional export.

    ``scale`` keeps the measures as decimals with that many places: sums are then exact
    and the same in whatever order tasks finish. None keeps doubles.
    """
    measures = [
        F.col(f"_c{i + 3}").cast(f"decimal(18,{scale})" if scale is not None else "double")
        .alias(name)
        for i, name in enumerate(ACTIVITY_MEASURES)
    ]
    return fill_missing(raw).select(
        F.col("_c0").alias("square_id"),
        epoch_to_time(F.col("_c1")).alias("beginning_time"),
        slot_end(F.col("_c1")).alias("end_time"),
        F.lit(SLOT_MINUTES).alias("time_interval"),
        F.col("_c2").alias("country_code"),
        *measures,
    )


def _hour() -> Column:
    return F.window("beginning_time", HOUR)


def hourly_average(activity: DataFrame) -> DataFrame:
    """Average over the slots of each hour of the five measures added up: start, end."""
    total = reduce(add, [F.col(name) for name in ACTIVITY_MEASURES])
    average = F.sum(total).cast("double") / F.count(total)
    return (
        activity.groupBy(_hour())
        .agg(average.alias("hourly_average"))
        .select("window.start", "window.end", "hourly_average")
    )


def peak_hour(hours: DataFrame) -> DataFrame:
    """The hour with the highest average, the earliest of equals, as one row."""
    rank = F.struct("hourly_average", -F.unix_micros("start"))
    peak = F.max_by(F.struct("start", "end", "hourly_average"), rank)
    return hours.agg(peak.alias("peak")).select("peak.*")


def hourly_internet_by_square(activity: DataFrame) -> DataFrame:
    """Internet traffic per hour and square: start, end, square_id, usage."""
    return (
        activity.groupBy(_hour(), "square_id")
        .agg(F.sum("internet_traffic_activity").alias("hourly_internet_usage"))
        .select("window.start", "window.end", "square_id", "hourly_internet_usage")
    )
