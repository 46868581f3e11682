"""Periods, row numbers and marts, against brute force and by their plans."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ringledger.operators import numbering
from ringledger.operators.joins import join_per_file
from ringledger.operators.numbering import first_rows, number_batches, number_rows
from ringledger.operators.period import (
    NO_STATE,
    Period,
    high_watermark,
    incremental,
    max_month_in_year,
    max_year,
    table_watermark,
)
from ringledger.plans.feeds import normalise_celcom_monthly, normalise_maxis_monthly
from ringledger.plans.marts import employee_itemized_bill, employee_monthly_top
from ringledger.schemas import (
    CELCOM_HEADERS,
    EMPLOYEE_MASTER,
    ITEMIZED_BILL,
    MONTHLY_BILL_SUMMARY,
    MONTHS,
)
from ringledger.sinks.tables import append_table


@pytest.fixture(scope="module")
def bills(spark):
    rows = [(y, m, y * 12 + i) for y in (1999, 2000, 2001) for i, m in enumerate(MONTHS, 1)]
    rows.append((2000, "may", None))
    return spark.createDataFrame(rows, "billing_year int, billing_month string, p int")


def _periods(df):
    return sorted(row["p"] for row in df.collect())


def test_incremental_crosses_the_year(bills):
    found = _periods(incremental(bills, Period(2000, 10), Period(2001, 2)))
    assert found == [2000 * 12 + 11, 2000 * 12 + 12, 2001 * 12 + 1, 2001 * 12 + 2]


def test_incremental_edges(bills):
    assert incremental(bills, NO_STATE, Period(2001, 2)).count() == bills.count()
    assert incremental(bills, Period(2000, 0), Period(2001, 2)).count() == bills.count()
    assert _periods(incremental(bills, Period(2000, 12), Period(2000, 12))) == []
    assert _periods(incremental(bills, Period(2001, 2), Period(2000, 12))) == []


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1999 * 12 + 1, 2001 * 12 + 12), min_size=3, max_size=3))
def test_incremental_steps_add_up(bills, points):
    a, b, c = [Period((n - 1) // 12, (n - 1) % 12 + 1) for n in sorted(points)]
    steps = _periods(incremental(bills, a, b)) + _periods(incremental(bills, b, c))
    assert sorted(steps) == _periods(incremental(bills, a, c))


def test_watermarks(bills, spark):
    assert tuple(high_watermark(bills).first()) == (2001 * 12 + 12, 2001, 12)
    none = bills.where("false")
    assert tuple(high_watermark(none).first()) == (0, 0, 0)
    assert max_year(none).first()[0] == 0
    assert max_month_in_year(bills, 1900).first()[0] == 0
    assert table_watermark(spark, "no_such_bills") == NO_STATE


def test_table_watermark_reads_the_partition_list(bills, spark):
    append_table(bills.where("p <= 24010"), "watermark_flat")
    append_table(bills.where("p <= 24010"), "watermark_parts", ["billing_year", "billing_month"])
    assert table_watermark(spark, "watermark_flat") == Period(2000, 10)
    assert table_watermark(spark, "watermark_parts") == Period(2000, 10)


def test_incremental_prunes_partitions(bills, spark):
    append_table(bills.where("p > 0"), "pruned", ["billing_year", "billing_month"])
    new = incremental(spark.table("pruned"), Period(2000, 10), Period(2001, 2))
    assert new.count() == 4
    assert len(new.inputFiles()) == 4


def test_row_numbers_match_a_sort(spark):
    # A third of the rows share one key; the second column spreads them.
    rows = [(7 if i % 3 == 0 else i * 37 % 1000, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t int").repartition(11)
    found = {(r["k"], r["t"]): r["row_number"] for r in number_rows(df, "k", "t").collect()}
    assert found == {row: i for i, row in enumerate(sorted(rows), 1)}
    sizes = number_batches(df, 1000, "k", "t").groupBy("batch_number").count().collect()
    assert sorted((r["batch_number"], r["count"]) for r in sizes) == [
        (1, 1000), (2, 1000), (3, 1000),
    ]


def test_null_keys_are_the_first_rows(spark):
    df = spark.createDataFrame([(None,), (3,), (1,), (None,), (2,)], "k int")
    assert sorted(r["k"] or 0 for r in first_rows(df, 3, "k").collect()) == [0, 0, 1]
    assert [r["k"] for r in first_rows(df, 2, "k").collect()] == [None, None]


@pytest.mark.parametrize("n", [2, 600, 1500, 9000])
def test_first_rows_cut_ties_exactly(spark, n):
    df = spark.range(1500).select((F.col("id") % 3).alias("k"), "id").repartition(7)
    found = first_rows(df, n, "k").collect()
    expected = sorted((i % 3, i) for i in range(1500))[:n]
    assert sorted((r["k"], r["id"]) for r in found) == expected


@pytest.mark.parametrize("n", [0, 1, 250, 1000, 5000])
def test_first_rows(spark, n):
    df = spark.range(2000).select((F.col("id") * 7919 % 2000).alias("k")).repartition(9)
    found = sorted(r["k"] for r in first_rows(df, n, "k").collect())
    assert found == list(range(2000))[: n or 2000]


KINDS = [
    "id", "cast(id as int)", "id / 7", "cast(id / 7 as decimal(20, 3))", "cast(id % 9 as tinyint)",
    "date_add(date'2000-01-01', cast(id as int))", "timestamp_seconds(id * 977)", "id % 5 = 0",
    "concat('long common prefix ', lpad(id % 1500, 5, '0'))", "concat(char(65 + id % 26), id)",
    "if(id % 50 = 0, double('NaN'), double(id - 900))", "if(id % 3 = 0, 7, id)",
    "timestamp_ntz'2000-01-01 00:00:00' + make_interval(0, 0, 0, cast(id as int))",
]


@pytest.mark.parametrize("kind", KINDS)
def test_first_rows_of_every_kind_of_key(spark, monkeypatch, kind):
    monkeypatch.setattr(numbering, "RANKED_AT_ONCE", 50)
    df = spark.range(2000).selectExpr(
        f"if(id % 100 = 3, null, {kind}) as k", "id"
    ).repartition(5)
    order = df.orderBy(F.col("k").asc_nulls_first(), "id").collect()
    for n in (20, 21, 777):
        found = first_rows(df, n, "k").collect()
        assert sorted(r["id"] for r in found) == sorted(r["id"] for r in order[:n])


def test_a_limit_stages_and_ranges_no_keys(spark, tmp_path, monkeypatch):
    spark.range(400_000).selectExpr("id * 7919 % 400009 as k", "id as v").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    monkeypatch.setattr(numbering, "staged", None)
    found = first_rows(df, 1000, "k")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "LessThanOrEqual(k," in plan
    assert found.count() == 1000


def _typed(spark, schema, rows):
    blank = dict.fromkeys(schema.names)
    return spark.createDataFrame([tuple({**blank, **row}.values()) for row in rows], schema)


def test_marts_match_brute_force(spark):
    staff = _typed(spark, EMPLOYEE_MASTER, [
        {"contact_number": 1, "username": "a", "STD_code": "01"},
        {"contact_number": 1, "username": "a", "STD_code": "01"},
        {"contact_number": 1, "username": "b", "STD_code": "02"},
        {"contact_number": None, "username": "c"},
    ])
    monthly = _typed(spark, MONTHLY_BILL_SUMMARY, [
        {"phone_number": 1, "STD_code": "01", "account_number": 5, "total": 1.0},
        {"phone_number": 1, "STD_code": "01", "account_number": 5, "total": 1.0},
        {"phone_number": 1, "STD_code": "01", "account_number": 6, "total": 1.0},
        {"phone_number": 2, "STD_code": "01", "total": 9.0},
        {"phone_number": None, "total": 9.0},
    ])
    top = employee_monthly_top(staff, monthly)
    # Distinct whole pairs: two bills (accounts 5 and 6) for each of a and b.
    assert sorted((r["username"], r["total"]) for r in top.collect()) == [
        ("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 1.0),
    ]
    strict = employee_monthly_top(staff, monthly, match_std=True)
    assert [r["username"] for r in strict.collect()] == ["a", "a"]
    itemized = _typed(spark, ITEMIZED_BILL, [{"phone_number": 1, "total": 2.0}])
    joined = employee_itemized_bill(staff, itemized)
    assert sorted(r["username"] for r in joined.collect()) == ["a", "a", "b"]


@pytest.fixture
def shuffled_joins(spark):
    """Session in which no side is broadcast and small partitions count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.mark.parametrize("mart", ["itemized", "monthly"])
def test_a_hot_number_is_split(spark, shuffled_joins, mart):
    schema, build = {
        "itemized": (ITEMIZED_BILL, employee_itemized_bill),
        "monthly": (MONTHLY_BILL_SUMMARY, employee_monthly_top),
    }[mart]
    named = {
        "phone_number": F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long"),
        "total": F.col("id").cast("double"),
        "STD_code": F.concat(F.lit("code"), F.col("id")),
    }
    bills = spark.range(0, 60000, 1, 16).select(*[
        named.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schema
    ])
    staff = spark.range(60000).select(*[
        (F.col("id") if f.name == "contact_number" else F.lit("x")).cast(f.dataType)
        .alias(f.name)
        for f in EMPLOYEE_MASTER
    ])
    joined = build(staff, bills)
    rows = joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 60000
    assert "SortMergeJoin(skew=true)" in plan


def _sheets(spark, sheet, first, head, body):
    """Sheet rows of 300 workbooks, one of which holds a third of all lines."""
    path = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 299 + 1).cast("string")
    lines = spark.range(0, 60000, 1, 16).select(
        path.alias("path"), (first + F.col("id")).cast("int").alias("row"), body.alias("cells")
    )
    top = spark.range(300).select(
        F.col("id").cast("string").alias("path"), F.explode(head).alias("head")
    ).select("path", F.col("head.row").alias("row"), F.col("head.cells").alias("cells"))
    return top.unionByName(lines).select(
        "path", F.lit(sheet).alias("sheet"), F.lit(0).alias("sheet_index"), "row", "cells"
    )


def _head(row, **cells):
    pairs = [F.lit(x) for col, value in cells.items() for x in (int(col[1:]), value)]
    return F.struct(F.lit(row).alias("row"), F.create_map(*pairs).alias("cells"))


def _body(**cells):
    pairs = [x for col, value in cells.items() for x in (F.lit(int(col[1:])), value)]
    return F.create_map(*pairs)


def test_a_hot_workbook_is_split(spark, shuffled_joins):
    number, text = F.lit("5"), F.concat(F.lit("(01)"), F.col("id"))
    maxis = _sheets(
        spark, "Account Summary", 6, F.array(_head(0, c3="05/01/2018 - 28/01/2018")),
        _body(c1=text, c3=number, c4=number, c12=number),
    )
    names = {f"c{i}": name for i, name in enumerate(CELCOM_HEADERS, 1)}
    celcom = _sheets(
        spark, "Bill", 15, F.array(_head(4, c2="07 Jan 2018"), _head(14, **names)),
        _body(c1=F.concat(F.lit("01-"), F.col("id")), **{f"c{i}": number for i in range(2, 10)}),
    )
    for bills in (normalise_maxis_monthly(maxis), normalise_celcom_monthly(celcom)):
        rows = bills.collect()
        assert len(rows) == 60000
        assert {r["billing_month"] for r in rows} == {"January"}
        joins = [
            line for line in bills._jdf.queryExecution().executedPlan().toString().split("\n")
            if "SortMergeJoin" in line and "path" in line
        ]
        assert "skew=true" in joins[0]  # the outermost join, of rows with files


def test_a_hot_workbook_fills_no_partition(spark, shuffled_joins):
    files = spark.range(300).select(F.col("id").cast("string").alias("path"))
    path = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 299 + 1)
    rows = spark.range(60000).select(
        path.cast("string").alias("path"), F.col("id").cast("int").alias("row"),
        F.sha2(F.col("id").cast("string"), 256).alias("cells"),
    )
    joined = join_per_file(rows, files.distinct())
    held = joined.groupBy(F.spark_partition_id()).agg(
        F.count("*").alias("count"), F.max("cells")
    ).collect()
    assert sum(r["count"] for r in held) == 60000
    assert max(r["count"] for r in held) < 60000 / 4


def test_a_small_staff_list_is_broadcast(spark):
    staff = _typed(spark, EMPLOYEE_MASTER, [{"contact_number": 1}])
    bills = spark.range(10).select(*[
        (F.col("id") if f.name == "phone_number" else F.lit(None)).cast(f.dataType)
        .alias(f.name)
        for f in ITEMIZED_BILL
    ])
    joined = employee_itemized_bill(staff, bills)
    assert len(joined.collect()) == 1
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
