"""Landing folders, the whole refresh, and hourly activity over a stream."""

import datetime
import os
from pathlib import Path

from pyspark.sql import functions as F

from ringledger.operators.staging import folders
from ringledger.plans.activity import cleaned, hourly_average
from ringledger.plans.refresh import compact_landed, mart_progress, refresh
from ringledger.schemas import (
    ACTIVITY_TSV,
    CELCOM_HEADERS,
    CELCOM_MONTHLY_FOLDER,
    EMPLOYEE_FOLDER,
    EMPLOYEE_HEADERS,
    ITEMIZED_CSV,
    ITEMIZED_FOLDER,
    MAXIS_MONTHLY_FOLDER,
)
from ringledger.streaming.activity import compact_hours, read_hours, stream_hourly_average, write_hours
from ringledger.sinks.tables import replace_partitions
from ringledger.streaming.landing import (
    BATCH,
    FEED,
    FEEDS,
    archive_taken,
    ingest,
    land_waiting,
    landed_table,
    still_refused,
)
from workbooks import row_of, write_workbook


def _itemized(root, name, numbers):
    lines = [
        f"(012){n},01/02/18 - 05/02/18,10:00,voice,a,b,Roam,99,+6012x3,2,s,d,off-peak,1.5,0.5,1,x"
        for n in numbers
    ]
    folder = root / ITEMIZED_FOLDER
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([",".join(ITEMIZED_CSV.names), *lines]) + "\n")


def _maxis(root, month, numbers):
    lines = {
        7 + i: row_of(1, [f"(012){n}", "-", "plan", 10.5, 1, 2, 3, -1, None, None, None, 15.5])
        for i, n in enumerate(numbers)
    }
    lines[7 + len(numbers)] = row_of(1, ["Total", "", "x", "n/a"])
    write_workbook(root / MAXIS_MONTHLY_FOLDER / f"m{month}.xlsx", {
        "Account Summary": {
            1: {3: f"05/{month:02}/2018 - 28/{month:02}/2018"},
            6: row_of(1, ["Number", "", "", "Base"]), **lines,
        },
        "Tax Invoice": {8: {6: "No 123456789 / 1"}},
    })


def _celcom(root, month, numbers):
    write_workbook(root / CELCOM_MONTHLY_FOLDER / f"c{str(month)[:10]}.xlsx", {"Bill": {
        4: {2: f"07 {month} 2018" if isinstance(month, str) else month},
        14: row_of(3, CELCOM_HEADERS),
        **{15 + i: row_of(3, [f"013-{n}", 77, 78, 100, 20, 5, 1, -2, 24])
           for i, n in enumerate(numbers)},
        40: row_of(3, ["footer"]),
    }})


def _staff(root, name, numbers):
    write_workbook(root / EMPLOYEE_FOLDER / name, {"Master 18": {
        0: {0: "Staff"},
        3: row_of(0, EMPLOYEE_HEADERS),
        **{4 + i: row_of(0, [n, f"u{i}", f"u{i}", *["x"] * 13]) for i, n in enumerate(numbers)},
    }})


def test_refresh_takes_each_file_once_and_adds_new_periods(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "done"
    args = (spark, str(source), "bills_a", str(tmp_path / "state"), str(archive))
    _staff(source, "staff.xlsx", ["012-1111111", "013-2222222", "NEW", "null"])
    _itemized(source, "201801_a.csv", [1111111, 1111111, 5555555])
    _maxis(source, 1, [1111111, 5555555])
    _celcom(source, "Jan", [2222222])
    refresh(*args)

    def table(name):
        return spark.table(f"bills_a.{name}")

    assert table("employee_master").count() == 2
    assert table("itemized_bill").count() == 3
    assert table("monthly_bill_summary").count() == 3
    maxis = table("monthly_bill_summary").where("operator = 'MAXIS'").first()
    assert (maxis["account_number"], maxis["billing_month"], maxis["total"]) == (
        123456789, "January", 15.5,
    )
    celcom = table("monthly_bill_summary").where("operator = 'CELCOM'").first()
    assert (celcom["account_number"], celcom["STD_code"], celcom["total"]) == (77, "013", 24.0)
    assert celcom["value_added_service"] is None
    assert table("employee_itemized_bill").count() == 2
    assert sorted(
        (r["username"], r["operator"]) for r in table("employee_monthly_top_table").collect()
    ) == [("u0", "MAXIS"), ("u1", "CELCOM")]

    refresh(*args)  # nothing new
    _itemized(source, "201802_a.csv", [2222222])
    _celcom(source, datetime.datetime(2018, 2, 7), [2222222, 1111111])  # a date cell
    refresh(*args)
    assert table("employee_master").count() == 2
    assert table("itemized_bill").count() == 4
    assert table("monthly_bill_summary").count() == 5
    assert table("employee_itemized_bill").count() == 3
    assert table("employee_monthly_top_table").groupBy("billing_month").count().orderBy(
        "billing_month"
    ).collect() == [("February", 2), ("January", 2)]
    progress = mart_progress(spark, "bills_a", "employee_itemized_bill")
    assert progress.groupBy("feed").count().orderBy("feed").collect() == [
        ("employees", 1), ("itemized", 2)]
    assert not [p for p in source.rglob("*") if p.is_file() and not p.name.endswith(".crc")]
    taken = {p.name for p in archive.rglob("*") if p.is_file()}
    assert {"staff.xlsx", "201801_a.csv", "201802_a.csv", "m1.xlsx"} <= taken


def test_a_mart_that_failed_is_made_up_for(spark, tmp_path):
    source = tmp_path / "in"
    args = (spark, str(source), "bills_b", str(tmp_path / "state"))
    for feed in FEEDS:
        (source / feed.folder).mkdir(parents=True)
    _staff(source, "staff.xlsx", ["012-1111111"])
    _itemized(source, "201801_a.csv", [1111111])
    refresh(*args)
    # Files land, but the run ends before the marts are written.
    _itemized(source, "201803_a.csv", [1111111, 1111111])
    itemized = next(feed for feed in FEEDS if feed.name == "itemized")
    ingest(spark, itemized, str(source), "bills_b", str(tmp_path / "state")).awaitTermination()
    assert spark.table("bills_b.employee_itemized_bill").count() == 1
    refresh(*args)
    assert spark.table("bills_b.employee_itemized_bill").count() == 3


def test_late_bills_reach_the_marts(spark, tmp_path):
    source = tmp_path / "in"
    args = (spark, str(source), "bills_d", str(tmp_path / "state"))
    for feed in FEEDS:
        (source / feed.folder).mkdir(parents=True)
    _staff(source, "staff.xlsx", ["012-1111111", "013-12222222"])
    _maxis(source, 1, [1111111])
    _itemized(source, "209912_far.csv", [1111111])  # a misnamed file
    _itemized(source, "nameless.csv", [1111111])
    refresh(*args)
    top = lambda: sorted((r["username"], r["operator"]) for r in spark.table(
        "bills_d.employee_monthly_top_table").collect())
    assert top() == [("u0", "MAXIS")]
    _celcom(source, "Jan", [12222222, 2222222])  # the same month; one number of eight digits
    _itemized(source, "201801_a.csv", [1111111])
    _itemized(source, "unnamed.csv", [1111111])
    refresh(*args)
    assert top() == [("u0", "MAXIS"), ("u1", "CELCOM")]
    itemized = spark.table("bills_d.employee_itemized_bill")
    assert sorted(str(r["billing_year"]) for r in itemized.collect()) == ["2018", "2099", "None", "None"]
    refresh(*args)
    assert itemized.count() == 4


def _mart_files(spark, table):
    found = {}
    for row in spark.table(table).select("billing_month", "_metadata.file_path").distinct().collect():
        found.setdefault(row["billing_month"], set()).add(row["file_path"])
    return found


def test_late_staff_reach_the_marts(spark, tmp_path):
    def run(database, *steps):
        source = tmp_path / database
        for feed in FEEDS:
            (source / feed.folder).mkdir(parents=True)
        for step in steps:
            step(source)
            refresh(spark, str(source), database, str(tmp_path / f"{database}-state"))

    def bills(source):
        _itemized(source, "201801_a.csv", [1111111, 2222222])
        _itemized(source, "201802_a.csv", [2222222, 9999999])
        _itemized(source, "201803_a.csv", [1111111])
        _itemized(source, "nameless.csv", [3333333])
        _maxis(source, 1, [1111111, 2222222])
        _maxis(source, 2, [1111111])

    def staff(source):
        _staff(source, "first.xlsx", ["012-1111111"])

    def late(source):
        _staff(source, "late.xlsx", ["012-2222222", "012-3333333", "012-4444444"])

    marts = ["employee_itemized_bill", "employee_monthly_top_table"]
    rows = lambda name: sorted(map(str, spark.table(name).collect()))
    run("bills_late", bills, staff)
    assert spark.table("bills_late.employee_itemized_bill").count() == 2
    before = {mart: _mart_files(spark, f"bills_late.{mart}") for mart in marts}
    late(tmp_path / "bills_late")
    refresh(spark, str(tmp_path / "bills_late"), "bills_late", str(tmp_path / "bills_late-state"))
    run("bills_once", lambda source: (bills(source), staff(source), late(source)))
    for mart in marts:
        assert rows(f"bills_late.{mart}") == rows(f"bills_once.{mart}")
    after = {mart: _mart_files(spark, f"bills_late.{mart}") for mart in marts}
    itemized, monthly = (
        {month for month in after[mart] if after[mart][month] != before[mart].get(month)}
        for mart in marts
    )
    assert itemized == {"January", "February", None} and monthly == {"January"}
    # Nothing is new any more.
    refresh(spark, str(tmp_path / "bills_late"), "bills_late", str(tmp_path / "bills_late-state"))
    assert {mart: _mart_files(spark, f"bills_late.{mart}") for mart in marts} == after
    # Two staff batches are merged; no mart takes the merged one for a new one.
    assert compact_landed(spark, "bills_late") == 2
    refresh(spark, str(tmp_path / "bills_late"), "bills_late", str(tmp_path / "bills_late-state"))
    assert spark.table("bills_late.employee_master").count() == 4
    assert {mart: _mart_files(spark, f"bills_late.{mart}") for mart in marts} == after


def _waiting(folder):
    return sorted(p.name for p in folder.iterdir() if not p.name.endswith(".crc"))


def test_refused_workbooks_hold_up_no_others(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "done"
    feed = next(feed for feed in FEEDS if feed.name == "celcom_monthly")
    spark.sql("CREATE DATABASE IF NOT EXISTS bills_e")
    run = lambda: land_waiting(
        spark, feed, str(source), "bills_e", str(tmp_path / "state"), str(archive))
    landed = lambda: sorted(r[0] for r in spark.table(
        "bills_e.monthly_bill_summary").select("phone_number").collect())
    _celcom(source, "Jan", [2222222])
    _celcom(source, "Feb", [3333333])
    folder = source / feed.folder
    write_workbook(folder / "bad.xlsx", {"Bill": {14: row_of(1, ["Mobile", *CELCOM_HEADERS[1:]])}})
    (folder / "torn.xlsx").write_bytes((folder / "cJan.xlsx").read_bytes()[:300])
    run()
    assert landed() == [2222222, 3333333]
    reasons = {Path(r["path"]).name: r["reason"] for r in spark.table("bills_e.refused_files").collect()}
    assert "header" in reasons["bad.xlsx"] and "no workbook" in reasons["torn.xlsx"]
    # What was taken is archived after the run, what was refused waits.
    assert _waiting(folder) == ["bad.xlsx", "torn.xlsx"]
    run()
    assert landed() == [2222222, 3333333]
    _celcom(source, "Mar", [4444444])
    (folder / "cMar.xlsx").replace(folder / "bad.xlsx")
    os.utime(folder / "bad.xlsx", (2_000_000_000, 2_000_000_000))
    _celcom(source, "Apr", [5555555])
    for _ in range(2):
        run()
        assert landed() == [2222222, 3333333, 4444444, 5555555]
    assert still_refused(spark, feed, "bills_e").count() == 1
    assert sorted(r[0] for r in spark.table("bills_e.monthly_bill_summary").select(
        "billing_month").collect()) == ["April", "February", "January", "March"]


def test_a_csv_without_header_holds_up_no_others(spark, tmp_path):
    feed = next(feed for feed in FEEDS if feed.name == "itemized")
    spark.sql("CREATE DATABASE IF NOT EXISTS bills_f")
    args = (spark, feed, str(tmp_path / "in"), "bills_f", str(tmp_path / "state"))
    _itemized(tmp_path / "in", "201801_a.csv", [1111111])
    _itemized(tmp_path / "in", "201802 b+%.csv", [1111111, 2222222])
    folder = tmp_path / "in" / feed.folder
    (folder / "201803_c.csv").write_text("no header here\n1,2\n")
    ingest(*args).awaitTermination()
    assert spark.table("bills_f.itemized_bill").count() == 3
    # A crash between commit and move: nothing is archived yet, and the next run makes up for it.
    assert len(_waiting(folder)) == 3
    later = folder / "201804_d.csv"  # not taken yet
    later.write_text("x")
    assert archive_taken(*args, str(tmp_path / "done")) == 2
    assert archive_taken(*args, str(tmp_path / "done")) == 0
    assert _waiting(folder) == ["201803_c.csv", "201804_d.csv"]


def test_a_repeated_batch_changes_nothing(spark):
    itemized = next(feed for feed in FEEDS if feed.name == "itemized")
    spark.sql("CREATE DATABASE IF NOT EXISTS bills_c")
    table = landed_table(spark, "bills_c", itemized)
    rows = spark.range(5).select(*[
        F.lit("January" if f.name == "billing_month" else None).cast(f.dataType).alias(f.name)
        for f in itemized.schema
    ]).withColumns({FEED: F.lit("itemized"), BATCH: F.lit(0).cast("long")})
    for _ in range(2):
        replace_partitions(rows, table)
    replace_partitions(rows.withColumn(BATCH, F.lit(1).cast("long")), table)
    assert spark.table(table).count() == 10


def test_streamed_hours_equal_batch_hours(spark, tmp_path):
    begin = 1383260400000
    folder, checkpoint = tmp_path / "slots", str(tmp_path / "state")
    folder.mkdir()

    def arrive(name, slots):
        (folder / name).write_text("".join(
            f"{s % 3}\t{begin + s * 600_000}\t39\t{s % 5}.5\t\t1.0\t\t2.0\n" for s in slots
        ))

    def run():
        slots = (
            spark.readStream.schema(ACTIVITY_TSV).option("sep", "\t").csv(str(folder))
        )
        hours = stream_hourly_average(cleaned(slots, 2))
        out = str(tmp_path / "hours")
        write_hours(hours, out, checkpoint).trigger(availableNow=True).start().awaitTermination()
        return {(r["start"], r["hourly_average"]) for r in read_hours(spark, out).collect()}

    arrive("a.txt", range(0, 20))
    run()
    arrive("b.txt", [18, 19, 20, 30, 31])  # some rows come late
    streamed = run()
    batch = hourly_average(cleaned(
        spark.read.schema(ACTIVITY_TSV).option("sep", "\t").csv(str(folder)), 2
    ))
    assert streamed == {(r["start"], r["hourly_average"]) for r in batch.collect()}
    assert len(streamed) == 5


def test_rows_later_than_the_watermark_change_nothing(spark, tmp_path):
    begin, folder, out = 1383260400000, tmp_path / "slots", str(tmp_path / "hours")
    folder.mkdir()

    def run(name, slots):
        (folder / name).write_text("".join(
            f"1\t{begin + s * 600_000}\t39\t{value}\t0\t0\t0\t0\n" for s, value in slots
        ))
        slots = spark.readStream.schema(ACTIVITY_TSV).option("sep", "\t").csv(str(folder))
        hours = stream_hourly_average(cleaned(slots, 2))
        write_hours(hours, out, str(tmp_path / "state")).trigger(
            availableNow=True
        ).start().awaitTermination()
        found = read_hours(spark, out).orderBy("start").collect()
        return [r["hourly_average"] for r in found]

    assert run("a.tsv", [(0, 2), (6, 3)]) == [2.0, 3.0]
    assert run("b.tsv", [(6, 5), (300, 7)]) == [2.0, 4.0, 7.0]  # an hour of the stored day changes
    before = sorted(read_hours(spark, out).collect())
    compact_hours(spark, out)
    assert sorted(read_hours(spark, out).collect()) == before and len(folders(spark, out)) == 1
    assert run("c.tsv", [(0, 100), (301, 9)]) == [2.0, 4.0, 8.0]  # the first hour is closed
