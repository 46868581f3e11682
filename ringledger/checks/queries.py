"""One query per operator, each a function of the inputs."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ringledger.checks import raw
from ringledger.checks.inputs import Inputs, as_read
from ringledger.functions import casts, dates, text
from ringledger.operators import period
from ringledger.operators.numbering import number_batches
from ringledger.operators.period import NO_STATE, Period
from ringledger.operators.staging import shared_folder
from ringledger.plans import activity, feeds, marts
from ringledger.plans.copy import table_copy
from ringledger.schemas import (
    ITEMIZED_CSV,
    MONTHLY_BILL_SUMMARY,
    SPARK_TYPES,
)
from ringledger.sinks.tables import append_table
from ringledger.sources.files import read_itemized_csv
from ringledger.sources.relational import map_schema
from ringledger.sources.sheets import first_cells, sheet_range
from ringledger.streaming.activity import read_hours, stream_hourly_average, write_hours
from ringledger.streaming.slots import LATE, counted_hours, rejected_rows, write_slots

Query = Callable[[Inputs], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# Periods the incremental queries span; they cross a year end.
START, END = Period(2000, 10), Period(2001, 2)

# Places after the point of the test measures, summed exactly.
PLACES = 2


# --- sources -------------------------------------------------------------------------


@query
def sheet_range_header(inputs: Inputs) -> DataFrame:
    return feeds.employee_rows(inputs.staff_sheets()).select(
        "path", "row",
        F.col(feeds.STAFF_NUMBER).alias("number"),
        F.col("USER").alias("username"),
        F.col("Phone Model").alias("phone_model"),
        F.col("Department HR ").alias("department"),
    )


@query
def sheet_range_positional(inputs: Inputs) -> DataFrame:
    summary = sheet_range(inputs.maxis_sheets(), *feeds.MAXIS_SUMMARY_RANGE)
    return summary.select("path", "row", "_c0", "_c1", "_c2", "_c3", "_c7", "_c11")


@query
def sheet_range_empty_as_null(inputs: Inputs) -> DataFrame:
    rows = sheet_range(inputs.celcom_sheets(), *feeds.CELCOM_BILL_RANGE, empty_as_null=True)
    return rows.where(F.col("row") > 14).select("path", "row", *[f"_c{i}" for i in range(10)])


@query
def statement_period(inputs: Inputs) -> DataFrame:
    maxis = feeds.maxis_statement(inputs.maxis_sheets())
    celcom = feeds.celcom_statement(inputs.celcom_sheets())
    columns = ["path", "billing_month", "billing_year"]
    return maxis.select(*columns).unionByName(celcom.select(*columns))


@query
def account_number_from_cell(inputs: Inputs) -> DataFrame:
    cells = first_cells(inputs.maxis_sheets(), cell=feeds.MAXIS_ACCOUNT_CELL)
    return cells.select("path", text.account_number(F.col("cell")).alias("account_number"))


@query
def scan_monthly_all(inputs: Inputs) -> DataFrame:
    return inputs.monthly()


@query
def itemized_by_period(inputs: Inputs) -> DataFrame:
    return period.of_month(inputs.itemized(), "May", 1998)


@query
def monthly_by_period(inputs: Inputs) -> DataFrame:
    return period.of_month(inputs.monthly(), "May", 1998)


@query
def schema_type_map(inputs: Inputs) -> DataFrame:
    return map_schema(inputs.raw(raw.DESCRIBED)).select(
        F.col("Field").alias("field"),
        F.col("Type").alias("source_type"),
        "target_type", "mode", "known",
    )


@query
def empty_seed_union(inputs: Inputs) -> DataFrame:
    seed = inputs.spark.createDataFrame([], MONTHLY_BILL_SUMMARY)
    return seed.unionByName(period.of_month(inputs.monthly(), "June", 1999))


@query
def period_from_name(inputs: Inputs) -> DataFrame:
    name = F.col("file_name")
    return inputs.raw(raw.FILE_NAMES).select(
        "o_orderkey",
        dates.file_year(name).alias("billing_year"),
        dates.file_month(name).alias("billing_month"),
    )


# --- sinks ---------------------------------------------------------------------------


@query
def orc_append_roundtrip(inputs: Inputs) -> DataFrame:
    spark = inputs.spark
    path = shared_folder(spark, "orc")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    bills = inputs.monthly()
    maxis = bills.where(F.col("operator") == "MAXIS")
    celcom = bills.where(F.col("operator") == "CELCOM")
    by_period = [period.YEAR, period.MONTH]
    for part in (maxis, celcom.select(*reversed(bills.columns))):
        append_table(part, table, by_period, rebalance=True, path=path)
    return spark.table(table).select(*bills.columns)


@query
def batch_numbering(inputs: Inputs) -> DataFrame:
    orders = inputs.table("orders").select("o_orderkey", "o_custkey")
    return number_batches(orders, 1000, "o_orderkey")


@query
def limited_copy(inputs: Inputs) -> DataFrame:
    target = StructType([
        StructField("o_orderkey", SPARK_TYPES["INTEGER"]),
        StructField("o_totalprice", SPARK_TYPES["FLOAT"]),
        StructField("o_orderpriority", SPARK_TYPES["STRING"]),
    ])
    return table_copy(inputs.table("orders"), target, limit=500, key="o_orderkey")


# --- feeds ---------------------------------------------------------------------------


@query
def itemized_normalised(inputs: Inputs) -> DataFrame:
    return feeds.normalise_itemized(as_read(inputs.raw(raw.ITEMIZED_TEXT)))


@query
def itemized_csv_by_header(inputs: Inputs) -> DataFrame:
    """Bills written as CSV files of two column orders and read back by their headers."""
    bills, folder = inputs.raw(raw.ITEMIZED_TEXT), shared_folder(inputs.spark, "csv")
    names = [f"`{name}`" for name in ITEMIZED_CSV.names]
    first = F.col("Type") == "R"
    for part, some in (("plain", bills.where(first).select(*names)),
                       ("turned", bills.where(~first).select(F.lit("?").alias("more"), *reversed(names)))):
        some.write.option("header", True).csv(f"{folder}/{part}")
    return read_itemized_csv(inputs.spark, [f"{folder}/plain", f"{folder}/turned"]).select(*names)


@query
def maxis_monthly_normalised(inputs: Inputs) -> DataFrame:
    return feeds.normalise_maxis_monthly(inputs.maxis_sheets())


@query
def celcom_monthly_normalised(inputs: Inputs) -> DataFrame:
    return feeds.normalise_celcom_monthly(inputs.celcom_sheets())


@query
def employee_master_normalised(inputs: Inputs) -> DataFrame:
    return feeds.normalise_employees(feeds.employee_rows(inputs.staff_sheets()))


@query
def bill_header_join(inputs: Inputs) -> DataFrame:
    rows = inputs.maxis_sheets()
    lines = feeds.maxis_bill_lines(rows).select("path", "row", "_c0")
    return feeds.with_statement(lines, feeds.maxis_statement(rows))


@query
def feed_row_counts(inputs: Inputs) -> DataFrame:
    monthly = feeds.normalise_maxis_monthly(inputs.maxis_sheets()).unionByName(
        feeds.normalise_celcom_monthly(inputs.celcom_sheets())
    )
    itemized = feeds.normalise_itemized(as_read(inputs.raw(raw.ITEMIZED_TEXT)))
    return (
        monthly.select(F.lit("monthly").alias("feed"), "operator")
        .unionByName(itemized.select(F.lit("itemized").alias("feed"), "operator"))
        .groupBy("feed", "operator")
        .agg(F.count("*").alias("row_count"))
    )


@query
def filter_not_null_all(inputs: Inputs) -> DataFrame:
    rows = sheet_range(inputs.maxis_sheets(), *feeds.MAXIS_SUMMARY_RANGE)
    kept = rows.dropna("any", subset=["_c2", "_c3", "_c11"])
    return kept.select("path", "row", "_c0", "_c3", "_c11")


@query
def filter_castable(inputs: Inputs) -> DataFrame:
    lines = feeds.maxis_bill_lines(inputs.maxis_sheets())
    return lines.select("path", "row", F.col("_c3").try_cast("double").alias("base_charges"))


@query
def employee_placeholder_filter(inputs: Inputs) -> DataFrame:
    staff = feeds.without_placeholders(feeds.employee_rows(inputs.staff_sheets()))
    return staff.select(F.col(feeds.STAFF_NUMBER).alias("number"), F.col("USER").alias("username"))


# --- functions -----------------------------------------------------------------------


def _on_number(inputs: Inputs, column: str, function: Callable[[Column], Column]) -> DataFrame:
    result = function(F.col(column)).alias("result")
    return inputs.raw(raw.NUMBERS).select("o_orderkey", column, result)


@query
def fn_null_if_hyphen(inputs: Inputs) -> DataFrame:
    return _on_number(inputs, "hyphenated", text.null_if_hyphen)


@query
def fn_digits_only(inputs: Inputs) -> DataFrame:
    return _on_number(inputs, "bracketed", text.digits_only)


@query
def fn_bracket_code(inputs: Inputs) -> DataFrame:
    return _on_number(inputs, "bracketed", text.bracket_code)


@query
def fn_bracket_tail(inputs: Inputs) -> DataFrame:
    return _on_number(inputs, "bracketed", text.bracket_tail)


@query
def fn_bracket_tail_strict(inputs: Inputs) -> DataFrame:
    return _on_number(inputs, "bracketed", text.bracket_tail_strict)


@query
def fn_range_start(inputs: Inputs) -> DataFrame:
    return _on_number(inputs, "hyphenated", text.range_start)


@query
def fn_range_end(inputs: Inputs) -> DataFrame:
    return _on_number(inputs, "hyphenated", text.range_end)


@query
def fn_hyphen_code(inputs: Inputs) -> DataFrame:
    return _on_number(inputs, "hyphenated", text.hyphen_code)


@query
def fn_hyphen_tail7(inputs: Inputs) -> DataFrame:
    return _on_number(inputs, "hyphenated", text.hyphen_tail)


@query
def fn_std_code(inputs: Inputs) -> DataFrame:
    return _on_number(inputs, "hyphenated", text.std_code)


@query
def fn_strip_brackets(inputs: Inputs) -> DataFrame:
    return _on_number(inputs, "bracketed", text.strip_brackets)


@query
def fn_strip_hyphens(inputs: Inputs) -> DataFrame:
    return _on_number(inputs, "hyphenated", text.strip_hyphens)


@query
def fn_parse_short_date(inputs: Inputs) -> DataFrame:
    parsed = dates.short_date(F.col("day_text")).alias("result")
    return inputs.raw(raw.SHIP_DATES).select("l_orderkey", "l_linenumber", "day_text", parsed)


@query
def fn_month_number(inputs: Inputs) -> DataFrame:
    number = dates.month_number(F.col("month_text")).alias("result")
    return inputs.raw(raw.MONTH_TEXTS).select("o_orderkey", "month_text", number)


@query
def fn_month_name(inputs: Inputs) -> DataFrame:
    index = F.col("month_index")
    return inputs.raw(raw.MONTH_TEXTS).select(
        "o_orderkey",
        dates.month_name(index).alias("from_one"),
        dates.month_name_from_zero(index).alias("from_zero"),
    )


@query
def fn_try_cast(inputs: Inputs) -> DataFrame:
    return inputs.raw(raw.NUMBERS).select(
        "o_orderkey",
        casts.whole(F.col("whole")).alias("as_long"),
        casts.whole(F.col("whole"), "int").alias("as_int"),
        F.col("money").try_cast("double").alias("as_double"),
        F.col("day").try_cast("date").alias("as_date"),
    )


@query
def fn_unix_seconds(inputs: Inputs) -> DataFrame:
    seconds = dates.unix_seconds(F.col("ts")).alias("seconds")
    return inputs.table("events").select("event_id", seconds)


# --- billing periods -----------------------------------------------------------------


def _of_both(inputs: Inputs, summarise: Callable[[DataFrame], DataFrame]) -> DataFrame:
    itemized, monthly = summarise(inputs.itemized()), summarise(inputs.monthly())
    return itemized.select(F.lit("itemized").alias("bills"), "*").unionByName(
        monthly.select(F.lit("monthly").alias("bills"), "*")
    )


@query
def max_billing_year(inputs: Inputs) -> DataFrame:
    return _of_both(inputs, period.max_year)


@query
def max_billing_month_in_year(inputs: Inputs) -> DataFrame:
    known = _of_both(inputs, lambda bills: period.max_month_in_year(bills, 2001))
    absent = period.max_month_in_year(inputs.monthly(), 1990)
    return known.unionByName(absent.select(F.lit("no such year").alias("bills"), "*"))


@query
def high_watermark_period(inputs: Inputs) -> DataFrame:
    return _of_both(inputs, period.high_watermark)


@query
def months_of_year(inputs: Inputs) -> DataFrame:
    return _of_both(inputs, lambda bills: period.months_of_year(bills, 2001))


@query
def itemized_incremental(inputs: Inputs) -> DataFrame:
    return period.incremental(inputs.itemized(), START, END)


@query
def monthly_incremental(inputs: Inputs) -> DataFrame:
    return period.incremental(inputs.monthly(), START, END)


@query
def full_load_when_no_state(inputs: Inputs) -> DataFrame:
    return period.incremental(inputs.monthly(), NO_STATE, END)


# --- marts ---------------------------------------------------------------------------


@query
def employee_itemized_bill(inputs: Inputs) -> DataFrame:
    return marts.employee_itemized_bill(inputs.employees(), inputs.itemized())


@query
def employee_monthly_top(inputs: Inputs) -> DataFrame:
    return marts.employee_monthly_top(inputs.employees(), inputs.monthly())


@query
def monthly_union_operators(inputs: Inputs) -> DataFrame:
    maxis = feeds.normalise_maxis_monthly(inputs.maxis_sheets())
    celcom = feeds.normalise_celcom_monthly(inputs.celcom_sheets())
    return marts.monthly_union(maxis, celcom.select(*reversed(celcom.columns)))


# --- activity ------------------------------------------------------------------------


def _clocks(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: dates.to_utc_clock(F.col(name)) for name in names})


def _as_doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


@query
def activity_null_fill(inputs: Inputs) -> DataFrame:
    return activity.fill_missing(inputs.activity())


@query
def activity_cleaned(inputs: Inputs) -> DataFrame:
    return _clocks(activity.cleaned(inputs.activity()), "beginning_time", "end_time")


@query
def hourly_average_activity(inputs: Inputs) -> DataFrame:
    hours = activity.hourly_average(activity.cleaned(inputs.activity(), PLACES))
    return _clocks(hours, "start", "end").orderBy("start")


@query
def peak_hour(inputs: Inputs) -> DataFrame:
    hours = activity.hourly_average(activity.cleaned(inputs.activity(), PLACES))
    return _clocks(activity.peak_hour(hours), "start", "end")


@query
def hourly_internet_by_square(inputs: Inputs) -> DataFrame:
    usage = activity.hourly_internet_by_square(activity.cleaned(inputs.activity(), PLACES))
    usage = _as_doubles(_clocks(usage, "start", "end"), "hourly_internet_usage")
    return usage.orderBy("start", "square_id")


@query
def stream_hourly_activity(inputs: Inputs) -> DataFrame:
    spark = inputs.spark
    arriving = (
        spark.readStream.schema(inputs.table("events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(inputs.folder)
    )
    view = f"arriving_{shared_folder(spark, 'x').rsplit('-', 1)[1]}"
    arriving.createOrReplaceTempView(view)
    slots = spark.sql(raw.ACTIVITY.format(millis=raw.SPARK_MILLIS, events=view))
    hours = stream_hourly_average(activity.cleaned(slots, PLACES))
    path = shared_folder(spark, "hours")
    write_hours(hours, path, shared_folder(spark, "hours-state")).trigger(
        availableNow=True
    ).start().awaitTermination()
    spark.catalog.dropTempView(view)
    return _clocks(read_hours(spark, path).select(*hours.columns), "start", "end")


# Quarters of the events' time, in which they arrive; some rows come a quarter late.
ARRIVALS = 4


@query
def stream_hourly_late_rows(inputs: Inputs) -> DataFrame:
    spark, slots = inputs.spark, inputs.activity()
    low, high = slots.agg(F.min("_c1"), F.max("_c1")).first()
    quarter = F.expr(f"{ARRIVALS} * (_c1 - {low or 0}) div ({high or 0} + 1 - {low or 0})")
    turn = F.coalesce(quarter, F.lit(0)) + F.when(F.col("_c0") % 16 == 0, 1).otherwise(0)
    folder, path, state = (shared_folder(spark, x) for x in ("arriving", "counted", "counted-state"))
    for k in range(ARRIVALS + 1):
        slots.where(turn == k).write.mode("append").parquet(folder)
        arriving = spark.readStream.schema(slots.schema).parquet(folder)
        write_slots(activity.cleaned(arriving, PLACES), path, state).trigger(
            availableNow=True
        ).start().awaitTermination()
    late = rejected_rows(spark, path).where(F.col("reason") == LATE)
    late = late.groupBy(F.window("beginning_time", activity.HOUR)).agg(F.count("*").alias("n_late"))
    hours = counted_hours(spark, path).unionByName(
        late.select("window.start", "window.end", "n_late"), allowMissingColumns=True
    )
    told = hours.groupBy("start", "end").agg(
        F.max("hourly_average").alias("hourly_average"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("n_rows", "n_late")],
    )
    return _clocks(told, "start", "end")
