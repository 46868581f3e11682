"""Readers: CSV and TSV files, workbooks and sheet ranges, relational tables."""

import datetime as dt
import zipfile
from pathlib import Path

import pytest
from pyspark.sql.types import DoubleType, LongType, StringType, TimestampType

from ringledger.plans import feeds
from ringledger.schemas import ITEMIZED_CSV
from ringledger.sources.files import read_activity_tsv, read_itemized_csv
from ringledger.sources.relational import (
    bounds_query,
    columns_query,
    map_schema,
    range_predicates,
    read_table,
    starts_query,
    target_schema,
)
from ringledger.sources.sheets import first_cells, lacking, sheet_range, sheet_range_with_header
from ringledger.sources import workbook
from ringledger.sources.workbook import read_workbook_rows
from workbooks import row_of, write_workbook

HEADER = ",".join(ITEMIZED_CSV.names)
LINE = "(012)34,01/02/18 - 05/02/18,10:00,voice,a,b,Roam,99,+6012x3,2,s,d,peak,1.5,0.5,1,x"


def test_csv_is_read_by_header(spark, tmp_path):
    names = ["extra", *reversed(ITEMIZED_CSV.names)]
    values = ["?", *reversed(LINE.split(","))]
    (tmp_path / "201805_a.csv").write_text(",".join(names) + "\n" + ",".join(values) + "\n")
    row = read_itemized_csv(spark, str(tmp_path)).first()
    assert row["Calling Number"] == "(012)34"
    assert row["Call Type"] == "x"
    assert row["file_name"] == "201805_a.csv"
    bill = feeds.normalise_itemized(read_itemized_csv(spark, str(tmp_path))).first()
    assert (bill["phone_number"], bill["STD_code"]) == (34, "012")
    assert (bill["roaming_operator"], bill["operator"]) == ("Roam", "MAXIS")
    assert (bill["billing_month"], bill["billing_year"]) == ("May", 2018)
    assert str(bill["start_date"]) == "2018-02-01" and str(bill["end_date"]) == "2018-02-05"


def test_each_csv_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "201805_a.csv").write_text(f"{HEADER}\n{LINE}\n{LINE}\n")
    turned = [",".join(["?", *reversed(text.split(","))]) for text in (HEADER, LINE)]
    (tmp_path / "201806_b.csv").write_text("\n".join(turned) + "\n")
    rows = read_itemized_csv(spark, str(tmp_path)).select(*ITEMIZED_CSV.names).collect()
    assert [",".join(row) for row in rows] == [LINE] * 3


def test_a_header_far_to_the_right(spark, tmp_path):
    wide = [f"x{k}" for k in range(300)]
    lines = [",".join([*wide, *ITEMIZED_CSV.names]), ",".join(['"a,b"'] * 300) + "," + LINE, "", " "]
    (tmp_path / "201805_a.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "201806_b.csv").write_text(f"{HEADER}\n{LINE}\n{HEADER}\n")
    rows = read_itemized_csv(spark, str(tmp_path)).select(*ITEMIZED_CSV.names).collect()
    assert [",".join(row) for row in rows] == [LINE] * 2


def test_lines_stay_where_they_are_read(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"20180{k + 1}_a.csv").write_text("\n".join([HEADER, *[LINE] * 500]) + "\n")
    found = read_itemized_csv(spark, str(tmp_path))
    assert found.count() == 1500
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan and plan.count("FileScan text") == 1
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    # Past the threshold both sides are shuffled instead.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = read_itemized_csv(spark, str(tmp_path))
        assert sorted(map(str, other.collect())) == sorted(map(str, found.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_csv_without_the_needed_header_raises(spark, tmp_path):
    (tmp_path / "201805_a.csv").write_text(f"{HEADER}\n{LINE}\n")
    (tmp_path / "201806_b.csv").write_text(f"{HEADER.replace('Total', 'Sum')}\n{LINE}\n")
    with pytest.raises(Exception, match="201806_b.csv"):
        read_itemized_csv(spark, str(tmp_path)).collect()


def test_date_cells_are_shown_as_dates(spark, tmp_path):
    moments = [dt.datetime(2018, 2, 7), dt.datetime(1979, 5, 1, 12, 30)]
    write_workbook(tmp_path / "a.xlsx", {"S": {0: {0: moments[0], 1: moments[1], 2: 43138, 3: "x"}}})
    cells = read_workbook_rows(spark, str(tmp_path)).first()["cells"]
    assert cells == {0: "2018-02-07", 1: "1979-05-01 12:30:00", 2: "43138", 3: "x"}


def test_files_that_lack_a_sheet_or_header_are_told(spark, tmp_path):
    for name, sheets in {
        "good": {"S": {2: {0: "A", 1: "B"}}}, "renamed": {"S": {2: {0: "A", 1: "b"}}},
        "bare": {"S": {5: {0: "1"}}}, "other": {"T": {2: {0: "A", 1: "B"}}},
    }.items():
        write_workbook(tmp_path / f"{name}.xlsx", sheets)
    rows = read_workbook_rows(spark, str(tmp_path))

    def found(*part):
        return sorted(Path(r["path"]).stem for r in lacking(rows, *part).collect())

    assert found("S", 0, 5, 2, ["A", "B"]) == ["bare", "other", "renamed"]
    assert found("S", 0, 5, 2) == ["other"]
    assert found(None, 0, 0, 2, ["A"]) == ["bare"]


def test_activity_tsv(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\t1383260400000\t39\t0.1\t\t0.2\t\t1.5\n")
    row = read_activity_tsv(spark, str(tmp_path)).first()
    assert tuple(row) == (1, 1383260400000, 39, 0.1, None, 0.2, None, 1.5)


@pytest.fixture
def book(tmp_path):
    path = tmp_path / "books" / "a.xlsx"
    write_workbook(path, {
        "First & only": {0: {0: "title"}, 3: row_of(1, ["A", "B", "C"]),
                         5: {1: "x", 2: 12.5, 3: None}, 6: {1: " ", 27: "far"}},
        "Second": {2: {3: "late"}, 9: {3: "later"}},
    })
    return str(path.parent)


def test_only_wanted_sheets_are_opened(spark, tmp_path, monkeypatch):
    sheets = {name: {k: {0: f"{name}{k}"} for k in range(5)} for name in ("one", "two", "three")}
    write_workbook(tmp_path / "b.xlsx", sheets)
    opened, real = [], zipfile.ZipFile.open
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda book, part, *args, **kw: (
        opened.append(getattr(part, "filename", part)), real(book, part, *args, **kw))[1])
    content = (tmp_path / "b.xlsx").read_bytes()
    rows = [row[:3] for row in workbook._book_rows(content, {"three": 2, None: 4})]
    assert rows == [("one", 0, 4), ("three", 2, 2), ("three", 2, 3), ("three", 2, 4)]
    assert [part for part in opened if "worksheets" in part] == [
        "xl/worksheets/sheet1.xml", "xl/worksheets/sheet3.xml"]
    files = spark.read.format("binaryFile").load(str(tmp_path))
    found = workbook.workbook_rows(files, {"three": 2, None: 4}).collect()
    assert [(r["sheet"], r["sheet_index"], r["row"]) for r in found] == rows
    (tmp_path / "torn.xlsx").write_bytes(content[:200])
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert workbook.workbook_rows(files, {"two": 0}, skip_broken=True).count() == 5
    with pytest.raises(Exception, match="BadZipFile"):
        workbook.workbook_rows(files).count()


def test_workbook_rows(spark, book):
    rows = read_workbook_rows(spark, book).orderBy("sheet_index", "row").collect()
    assert [(r["sheet"], r["row"], r["cells"]) for r in rows] == [
        ("First & only", 0, {0: "title"}),
        ("First & only", 3, {1: "A", 2: "B", 3: "C"}),
        ("First & only", 5, {1: "x", 2: "12.5"}),
        ("First & only", 6, {1: " ", 27: "far"}),
        ("Second", 2, {3: "late"}),
        ("Second", 9, {3: "later"}),
    ]


def test_ranges(spark, book):
    rows = read_workbook_rows(spark, book)
    ranged = sheet_range(rows, None, 1, 3, 3).orderBy("row").collect()
    assert [tuple(r)[1:] for r in ranged] == [
        (3, "A", "B", "C"), (5, "x", "12.5", None), (6, " ", None, None),
    ]
    named = sheet_range_with_header(rows, "First & only", 1, 3, 3, ["C", "A", "Z"])
    assert [tuple(r)[1:] for r in named.orderBy("row").collect()] == [
        (5, None, "x", None), (6, None, " ", None),
    ]
    empty = sheet_range_with_header(rows, None, 1, 3, 3, ["A"], empty_as_null=True)
    assert [r["A"] for r in empty.orderBy("row").collect()] == ["x", None]
    tops = first_cells(rows, top=("Second", 3, 3), none=("Second", 8, 0)).first()
    assert (tops["top"], tops["none"]) == ("later", None)


def test_many_rows_pass_in_batches(spark, tmp_path):
    path = tmp_path / "big" / "a.xlsx"
    write_workbook(path, {"S": {r: {0: r} for r in range(5001)}})
    rows = read_workbook_rows(spark, str(path.parent))
    assert rows.count() == 5001
    assert rows.selectExpr("sum(cast(cells[0] as int))").first()[0] == 5000 * 5001 // 2


DESCRIBED = [
    ("id", "int(11)", "NO"), ("price", "decimal(10,2)", "YES"), ("at", "datetime", "YES"),
    ("n", "int unsigned", "YES"), ("day", "date", "NO"),
]


def test_schema_map(spark):
    described = spark.createDataFrame(DESCRIBED, "Field string, Type string, `Null` string")
    mapped = {r["Field"]: (r["target_type"], r["mode"], r["known"])
              for r in map_schema(described).collect()}
    assert mapped == {
        "id": ("INTEGER", "REQUIRED", True),
        "price": ("FLOAT", "NULLABLE", True),
        "at": ("TIMESTAMP", "NULLABLE", True),
        "n": ("STRING", "NULLABLE", False),
        "day": ("STRING", "REQUIRED", False),
    }
    target = target_schema(described)
    assert [(f.name, f.dataType, f.nullable) for f in target] == [
        ("id", LongType(), False), ("price", DoubleType(), True),
        ("at", TimestampType(), True), ("n", StringType(), True), ("day", StringType(), False),
    ]


class _Reader:
    """Stands in for the JDBC reader, as no database may run here."""

    def __init__(self, bounds):
        self.bounds, self.calls = bounds, []

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        return self

    def first(self):
        return self.bounds

    def collect(self):
        return self.bounds


class _Session:
    def __init__(self, bounds):
        self.read = _Reader(bounds)


def test_table_read_is_split_by_key():
    session = _Session({"lo": 5, "hi": 900})
    read_table(session, "jdbc:x", "bills", {"user": "u"}, key="id", partitions=16)
    (bounds, _), (table, options) = session.read.calls
    assert bounds == bounds_query("bills", "id")
    assert (table, options["column"], options["numPartitions"]) == ("bills", "id", 16)
    assert (options["lowerBound"], options["upperBound"]) == (5, 900)


def test_empty_table_and_keyless_read_use_one_connection():
    session = _Session({"lo": None, "hi": None})
    read_table(session, "jdbc:x", "bills", {}, key="id", partitions=4)
    read_table(session, "jdbc:x", "bills", {})
    assert [set(options) for _, options in session.read.calls[1:]] == [{"properties"}] * 2


def test_even_ranges_take_every_row_once(spark):
    session = _Session([{"start": n} for n in (40, 1, 10, 10)])
    read_table(session, "jdbc:x", "bills", {}, key="id", partitions=4, even=True)
    (starts, _), (_, options) = session.read.calls
    assert starts == starts_query("bills", "id", 4)
    predicates = options["predicates"]
    assert predicates == ["id < 10 OR id IS NULL", "id >= 10 AND id < 40", "id >= 40"]
    keys = [None, -5, 1, 9, 10, 10, 39, 40, 900]
    df = spark.createDataFrame([(k,) for k in keys], "id int")
    taken = [r["id"] for p in predicates for r in df.where(p).collect()]
    assert sorted(taken, key=str) == sorted(keys, key=str)
    assert range_predicates("id", []) == range_predicates("id", [None, 3]) == ["1 = 1"]
    days = [dt.date(2018, 1, 1), dt.date(2018, 2, 1)]
    assert range_predicates("day", days)[-1] == "day >= '2018-02-01'"


def test_columns_query_names_the_table():
    assert "table_name = 'bills'" in columns_query("shop", "bills")
