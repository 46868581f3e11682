"""Billing periods: one comparable number per (year, month name), and what is new."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.functions.dates import month_number

YEAR = "billing_year"
MONTH = "billing_month"


@dataclass(frozen=True)
class Period:
    """Billing year and month number; year or month 0 means no state yet."""

    year: int
    month: int

    @property
    def known(self) -> bool:
        return self.year != 0 and self.month != 0

    @property
    def number(self) -> int:
        return self.year * 12 + self.month


NO_STATE = Period(0, 0)


def period_number() -> Column:
    """``year * 12 + month`` of a bill row, NULL without a proper month name."""
    return F.col(YEAR) * 12 + month_number(F.col(MONTH))


def of_month(bills: DataFrame, month: str, year: int) -> DataFrame:
    """Bills of one month; prunes to one partition of a period-partitioned table."""
    return bills.where((F.col(MONTH) == month) & (F.col(YEAR) == year))


def months_of_year(bills: DataFrame, year: int) -> DataFrame:
    """Distinct month names billed in a year."""
    return bills.where(F.col(YEAR) == year).select(MONTH).distinct()


def max_year(bills: DataFrame) -> DataFrame:
    """Latest billing year, 0 when there are no bills."""
    return bills.agg(F.coalesce(F.max(YEAR), F.lit(0)).alias("max_year"))


def max_month_in_year(bills: DataFrame, year: int) -> DataFrame:
    """Latest month number billed in a year, 0 when there is none."""
    latest = F.coalesce(F.max(month_number(F.col(MONTH))), F.lit(0))
    return bills.where(F.col(YEAR) == year).agg(latest.alias("max_month"))


def high_watermark(bills: DataFrame) -> DataFrame:
    """Latest period of the bills as one row: period number, year, month (0 when empty)."""
    latest = F.coalesce(F.max(period_number()), F.lit(0))
    year = F.expr("(billing_period - 1) div 12").cast("int")
    return bills.agg(latest.alias("billing_period")).select(
        "billing_period",
        F.when(F.col("billing_period") > 0, year).otherwise(0).alias("max_year"),
        F.when(F.col("billing_period") > 0, F.col("billing_period") - year * 12)
        .otherwise(0)
        .alias("max_month"),
    )


def table_watermark(spark: SparkSession, table: str) -> Period:
    """Latest period of a stored table, ``NO_STATE`` when it is absent or empty.

    A table partitioned by period answers from its partition list, without touching data.
    """
    if not spark.catalog.tableExists(table):
        return NO_STATE
    partitioned = {c.name for c in spark.catalog.listColumns(table) if c.isPartition}
    if {YEAR, MONTH} <= partitioned:
        listed = spark.sql(f"SHOW PARTITIONS {table}")
        bills = listed.select(
            F.regexp_extract("partition", rf"{YEAR}=(\d+)", 1).try_cast("int").alias(YEAR),
            F.regexp_extract("partition", rf"{MONTH}=([A-Za-z]+)", 1).alias(MONTH),
        )
    else:
        bills = spark.table(table).select(YEAR, MONTH)
    row = high_watermark(bills).first()
    return Period(row["max_year"], row["max_month"])


def incremental(bills: DataFrame, start: Period, end: Period) -> DataFrame:
    """Bills of the periods after ``start`` up to and including ``end``.

    Without a known start every bill is taken. The plain year bounds repeat what the
    period comparison says, in a form that file statistics and the metastore can use.
    """
    if not start.known:
        return bills
    number = period_number()
    return bills.where(
        F.col(YEAR).between(start.year, end.year)
        & (number > start.number)
        & (number <= end.number)
    )
