"""Small helpers shared by the text operators."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words of running text: blank, tab, line feed, vertical tab, form feed,
# carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def packed(df: DataFrame, **used: Column) -> DataFrame:
    """``row`` holds all columns of ``df``; ``used`` are computed beside it.

    Keeps an operator's own column names apart from whatever the table brings along.
    """
    whole = F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("row")
    return df.select(whole, *[value.alias(name) for name, value in used.items()])


def unpacked(df: DataFrame) -> DataFrame:
    """The columns of ``packed`` again."""
    return df.select("row.*")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words between blanks; none for null, empty and blank texts."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
