"""The whole run: land what is new in every feed, then bring the marts up to date."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ringledger.operators.staging import staged
from ringledger.plans.marts import employee_itemized_bill, employee_monthly_top
from ringledger.schemas import (
    EMPLOYEE_ITEMIZED_BILL,
    EMPLOYEE_MASTER,
    EMPLOYEE_MONTHLY_TOP,
    ITEMIZED_BILL,
    MONTHLY_BILL_SUMMARY,
)
from ringledger.sinks.compaction import compact, landed_rows
from ringledger.sinks.tables import append_table, ensure_table, rebalanced, replace_partitions
from ringledger.streaming.landing import BATCH, FEED, FEEDS, PERIOD, land_waiting

PROGRESS = StructType([
    StructField("mart", StringType()),
    StructField(FEED, StringType()),
    StructField(BATCH, LongType()),
])

BILL_PERIOD = {"billing_year": "int", "billing_month": "string"}

# How a table's partition list writes a NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def refresh(
    spark: SparkSession,
    source: str,
    database: str,
    checkpoints: str,
    archive: str | None = None,
) -> None:
    """Ingests all waiting files, then takes the new bills into both marts.

    Safe to run again after a failure anywhere: files count as taken only when landed,
    and a mart's progress is noted only after its periods are written.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for feed in FEEDS:
        land_waiting(spark, feed, source, database, checkpoints, archive)
    staff = landed_rows(spark, database, f"{database}.employee_master").select(
        *EMPLOYEE_MASTER.names
    )
    update_mart(
        spark, database, "employee_itemized_bill", EMPLOYEE_ITEMIZED_BILL,
        f"{database}.itemized_bill", ITEMIZED_BILL, f"{database}.employee_master",
        lambda bills: employee_itemized_bill(staff, bills),
    )
    update_mart(
        spark, database, "employee_monthly_top_table", EMPLOYEE_MONTHLY_TOP,
        f"{database}.monthly_bill_summary", MONTHLY_BILL_SUMMARY, f"{database}.employee_master",
        lambda bills: employee_monthly_top(staff, bills),
    )


MARTS_OF = {
    "itemized_bill": ["employee_itemized_bill"],
    "monthly_bill_summary": ["employee_monthly_top_table"],
    "employee_master": ["employee_itemized_bill", "employee_monthly_top_table"],
}


def compact_landed(spark: SparkSession, database: str) -> int:
    """Merges the small partitions of all landed tables that the marts have taken in.

    Meant for between two refreshes; returns how many partitions went.
    """
    return sum(
        compact(spark, database, f"{database}.{table}", marts) for table, marts in MARTS_OF.items()
        if spark.catalog.tableExists(f"{database}.{table}")
    )


def update_mart(
    spark: SparkSession,
    database: str,
    mart: str,
    mart_schema: StructType,
    bill_table: str,
    bill_schema: StructType,
    staff_table: str,
    build: Callable[[DataFrame], DataFrame],
) -> None:
    """Brings a mart up to date with the bill and staff batches it has not taken in yet.

    The periods that new bills touch, the undated one among them, and those that hold a bill of a
    newly landed staff number are rebuilt from all their bills and replaced whole. So late bills
    and late staff reach the mart, a repeated run adds nothing twice, and other periods are not
    written. What a mart has taken in is noted after it is written.
    """
    ensure_table(spark, f"{database}.{mart}", mart_schema, PERIOD)
    taken = mart_progress(spark, database, mart)
    bills_new = staged(
        _landed(spark, bill_table).join(taken, [FEED, BATCH], "left_anti"), "progress"
    )
    staff_new = staged(
        _landed(spark, staff_table, []).join(taken, [FEED, BATCH], "left_anti"), "progress"
    )
    # A row per new period; the partition list is all that is read.
    periods = _periods(bills_new)
    periods += periods_of_staff(
        landed_rows(spark, database, staff_table).join(staff_new, [FEED, BATCH], "left_semi"),
        landed_rows(spark, database, bill_table).where(~F.coalesce(_in_periods(periods), F.lit(False))),
    )
    if periods:
        bills = landed_rows(spark, database, bill_table).where(_in_periods(periods)).select(
            *bill_schema.names
        )
        replace_partitions(rebalanced(build(bills), PERIOD), f"{database}.{mart}")
    done = bills_new.select(FEED, BATCH).union(staff_new.select(FEED, BATCH)).distinct()
    if not done.isEmpty():
        append_table(
            done.select(F.lit(mart).alias("mart"), FEED, BATCH), f"{database}.mart_progress"
        )


def _periods(rows: DataFrame) -> list[tuple[int | None, str | None]]:
    """The distinct periods of some rows, as many as there are months."""
    return [(r[0], r[1]) for r in rows.select(*PERIOD).distinct().collect()]


def periods_of_staff(staff: DataFrame, bills: DataFrame) -> list[tuple[int | None, str | None]]:
    """Periods that hold a bill of one of the staff's numbers.

    The numbers are written first: by their size Spark tells whether the join needs a shuffle.
    Of the bills, only numbers and periods are read, and each pair of them meets once.
    """
    numbers = staged(staff.select("contact_number").distinct(), "changed-staff")
    if numbers.isEmpty():
        return []
    billed = bills.select("phone_number", *PERIOD).distinct()
    same = F.col("phone_number") == F.col("contact_number")
    return _periods(billed.join(numbers, same, "left_semi"))


def _landed(spark: SparkSession, table: str, periods: list[str] = PERIOD) -> DataFrame:
    """Feed and batch of every partition of a landed table, and its period if it has one."""
    listed = spark.sql(f"SHOW PARTITIONS {table}")

    def part(name: str) -> Column:
        text = F.regexp_extract("partition", f"(?:^|/){name}=([^/]*)", 1)
        return F.when(text != NO_VALUE, text)

    return listed.select(
        *[part(name).cast(BILL_PERIOD[name]).alias(name) for name in periods],
        part(FEED).alias(FEED), part(BATCH).cast("long").alias(BATCH),
    )


def _in_periods(periods: list[tuple[int | None, str | None]]) -> Column:
    """Whether a bill is of one of the periods; prunes to their partitions."""
    years: dict[int | None, list[str | None]] = {}
    for year, month in periods:
        years.setdefault(year, []).append(month)
    wanted = F.lit(False)
    for year, months in years.items():
        known = [month for month in months if month is not None]
        in_month = F.col("billing_month").isin(known)
        if None in months:
            in_month = F.coalesce(in_month, F.lit(False)) | F.col("billing_month").isNull()
        in_year = F.col("billing_year").isNull() if year is None else F.col("billing_year") == year
        wanted = wanted | (in_year & in_month)
    return wanted


def mart_progress(spark: SparkSession, database: str, mart: str) -> DataFrame:
    """Feed and batch of the bills a mart has taken in."""
    table = f"{database}.mart_progress"
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], PROGRESS).select(FEED, BATCH)
    return spark.table(table).where(F.col("mart") == mart).select(FEED, BATCH)
