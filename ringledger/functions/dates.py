"""Dates, epochs and billing months as built-in column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringledger.schemas import MONTHS

# Two-digit years below this are 20xx, the others 19xx, unless the caller says otherwise.
CENTURY_TURN = 50

ACTIVITY_SLOT_MILLIS = 600_000


def _month_names() -> Column:
    return F.array(*[F.lit(name) for name in MONTHS])


def month_number(name: Column) -> Column:
    """1..12 for a full English month name, NULL for anything else."""
    position = F.array_position(_month_names(), name)
    return F.when(position > 0, position.cast("int"))


def month_name(number: Column) -> Column:
    """Full English month name of 1..12, NULL outside."""
    return F.get(_month_names(), number - 1)


def month_name_from_zero(index: Column) -> Column:
    """Full English month name of 0..11, NULL outside."""
    return F.get(_month_names(), index)


def _slash_date(text: Column, century_turn: int) -> Column:
    """Date leading day/month/year text, put together as an ISO date and cast.

    Far cheaper than a format pattern, above all on text that is no date. What follows
    the year after a blank is ignored. Years have two or four digits.
    """
    day = F.substring_index(F.trim(text), " ", 1)
    year, start = F.substring_index(day, "/", -1), F.substring_index(day, "/", 2)
    two = F.length(year) == 2
    century = F.when(F.length(year) == 4, "").when(
        two & (year < f"{century_turn:02d}"), "20"
    ).when(two, "19")
    # The first two pieces and the year make up the whole text, or it has more or fewer.
    whole_text = F.length(start) + F.length(year) + 1 == F.length(day)
    return F.when(whole_text, F.concat(
        century, year, F.lit("-"), F.substring_index(start, "/", -1),
        F.lit("-"), F.substring_index(start, "/", 1),
    )).try_cast("date")


def short_date(text: Column, century_turn: int = CENTURY_TURN) -> Column:
    """Date of ``dd/MM/yy`` text (four-digit years pass too); NULL when it is no date.

    Two-digit years below ``century_turn`` are 20xx, the others 19xx.
    """
    return _slash_date(text, century_turn)


def statement_date(text: Column) -> Column:
    """Date leading a ``dd/MM/yyyy - dd/MM/yyyy`` statement period."""
    return _slash_date(F.substring(text, 1, 10), CENTURY_TURN)


def worded_date(text: Column) -> Column:
    """Date of ``dd MMM yyyy`` text, month short or written out."""
    day = F.trim(text)
    return F.coalesce(F.try_to_date(day, "d MMM yyyy"), F.try_to_date(day, "d MMMM yyyy"))


def cell_date(text: Column) -> Column:
    """Date of a date cell, which the workbook source gives as ``yyyy-MM-dd`` text."""
    return F.when(F.substring(text, 5, 1) == "-", F.substring(text, 1, 10)).try_cast("date")


def file_year(name: Column) -> Column:
    """Year from a file name starting ``yyyyMM``."""
    return F.substring(name, 1, 4).try_cast("int")


def file_month(name: Column) -> Column:
    """Month name from a file name starting ``yyyyMM``; NULL when the month is none."""
    return month_name(F.substring(name, 5, 2).try_cast("int"))


def epoch_to_time(millis: Column) -> Column:
    """Timestamp of an epoch value in milliseconds."""
    return F.timestamp_millis(millis)


def slot_end(begin_millis: Column) -> Column:
    """End of the ten-minute activity slot that begins at an epoch value."""
    return F.timestamp_millis(begin_millis + F.lit(ACTIVITY_SLOT_MILLIS))


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def unix_seconds(wall_clock: Column) -> Column:
    """Seconds since 1970 of a zoneless timestamp, with fraction."""
    return utc_micros(wall_clock) / F.lit(1e6)


def utc_micros(wall_clock: Column) -> Column:
    """Microseconds since 1970 of a zoneless timestamp read as UTC."""
    return F.timestamp_diff("MICROSECOND", _epoch(), wall_clock)


def from_utc_clock(wall_clock: Column) -> Column:
    """Instant of a zoneless timestamp read as UTC, whatever the session zone."""
    return F.timestamp_micros(utc_micros(wall_clock))


def to_utc_clock(instant: Column) -> Column:
    """Zoneless UTC reading of an instant, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())
