"""Workbook files (``.xlsx``) as a table of sheet rows.

The files are listed, split over tasks and read by Spark's ``binaryFile`` source, so any
file system Spark knows works. Only unpacking one workbook into its rows is Python: it
streams each sheet and hands the rows over in small Arrow batches.
"""

import datetime
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ringledger.schemas import SHEET_ROWS

ROWS_PER_BATCH = 2_000

# Number formats of the file format that show a date, and what else does.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
DATE_LETTERS = re.compile(r"[dmyhs]", re.IGNORECASE)
NOT_LETTERS = re.compile(r'"[^"]*"|\\.|\[[^\]]*\]')

# What unpacking raises for a file that is no workbook.
BROKEN = (zipfile.BadZipFile, ElementTree.ParseError, KeyError, StopIteration, EOFError)

_ARROW_ROWS = pa.schema([
    ("path", pa.string()),
    ("sheet", pa.string()),
    ("sheet_index", pa.int32()),
    ("row", pa.int32()),
    ("cells", pa.map_(pa.int32(), pa.string())),
])


def read_workbook_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every filled sheet row of the workbooks under ``path``: a file, folder or glob."""
    paths = [path] if isinstance(path, str) else path
    return workbook_rows(spark.read.format("binaryFile").load(paths))


def workbook_rows(
    files: DataFrame, sheets: dict[str | None, int] | None = None, skip_broken: bool = False
) -> DataFrame:
    """Sheet rows of ``binaryFile`` rows, with the filled cells as a map.

    Rows and columns count from zero. Numbers are given as stored, cells with a date style
    as ``yyyy-MM-dd`` with the time behind it where there is one, shared and inline text in
    full; a cell that holds nothing is absent.

    ``sheets`` names the sheets to unpack (None: the first) and the first row wanted of each;
    other sheets are not opened, and earlier rows are not handed over. With ``skip_broken``, a
    file that is no workbook gives no rows instead of raising.
    """

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                held = len(rows)
                try:
                    for row in _book_rows(content.as_py(), sheets):
                        rows.append((path.as_py(), *row))
                        if len(rows) == ROWS_PER_BATCH:
                            yield _to_batch(rows)
                            rows, held = [], 0
                except BROKEN:
                    if not skip_broken:
                        raise
                    rows = rows[:held]
        if rows:
            yield _to_batch(rows)

    return files.select("path", "content").mapInArrow(unpacked, SHEET_ROWS)


def _to_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), _ARROW_ROWS.types)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW_ROWS)


def _book_rows(
    content: bytes, sheets: dict[str | None, int] | None = None
) -> Iterator[tuple[str, int, int, list]]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared, dates = _shared_strings(book), _date_styles(book)
        for index, (name, part) in enumerate(_sheet_parts(book)):
            first = _first_row(sheets, name, index)
            if first is None:
                continue
            with book.open(part) as stream:
                for row, cells in _sheet_rows(stream, shared, dates):
                    if row >= first:
                        yield name, index, row, cells


def _first_row(sheets: dict[str | None, int] | None, name: str, index: int) -> int | None:
    """The first row wanted of a sheet, None for a sheet that is not wanted."""
    if sheets is None:
        return 0
    asked = [sheets[key] for key in ([name] if index else [name, None]) if key in sheets]
    return min(asked, default=None)


def _local(name: str) -> str:
    return name.rsplit("}", 1)[-1]


def _text(element: ElementTree.Element) -> str:
    return "".join(
        run.text or ""
        for item in element
        if _local(item.tag) != "rPh"
        for run in item.iter()
        if _local(run.tag) == "t"
    )


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as stream:
        root = ElementTree.parse(stream).getroot()
    return [_text(item) for item in root]


def _date_styles(book: zipfile.ZipFile) -> dict[str, datetime.datetime]:
    """Day zero of the book for every cell style that shows a date."""
    if "xl/styles.xml" not in book.namelist():
        return {}
    styles = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {
        item.get("numFmtId"): NOT_LETTERS.sub("", item.get("formatCode", ""))
        for item in styles.iter() if _local(item.tag) == "numFmt"
    }
    properties = ElementTree.fromstring(book.read("xl/workbook.xml")).iter()
    late = any(_local(p.tag) == "workbookPr" and p.get("date1904") in ("1", "true") for p in properties)
    zero = datetime.datetime(1904, 1, 1) if late else datetime.datetime(1899, 12, 30)
    formats = next((list(part) for part in styles if _local(part.tag) == "cellXfs"), [])
    found = {}
    for index, style in enumerate(formats):
        number = style.get("numFmtId", "0")
        if DATE_LETTERS.search(own[number]) if number in own else int(number) in DATE_FORMATS:
            found[str(index)] = zero
    return found


def _shown_date(stored: str, zero: datetime.datetime) -> str:
    """A day number as ISO text; what is no number, or out of range, as stored."""
    try:
        moment = zero + datetime.timedelta(seconds=round(float(stored) * 86_400))
    except (ValueError, OverflowError):
        return stored
    return str(moment.date()) if moment.time() == datetime.time() else str(moment)


def _sheet_parts(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    targets = {link.get("Id"): link.get("Target") for link in links}
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    parts = []
    for element in root.iter():
        if _local(element.tag) == "sheet":
            link = next(v for k, v in element.attrib.items() if _local(k) == "id")
            target = targets[link]
            part = target.lstrip("/") if target.startswith("/") else "xl/" + target
            parts.append((element.get("name"), part))
    return parts


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match("[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _sheet_rows(
    stream, shared: list[str], dates: dict[str, datetime.datetime]
) -> Iterator[tuple[int, list]]:
    row, table = -1, None
    for event, element in ElementTree.iterparse(stream, events=("start", "end")):
        tag = _local(element.tag)
        if event == "start" and tag == "sheetData":
            table = element
        elif event == "end" and tag == "row":
            row = int(element.get("r", row + 2)) - 1
            cells = list(_row_cells(element, shared, dates))
            if cells:
                yield row, cells
            table.clear()


def _row_cells(
    row: ElementTree.Element, shared: list[str], dates: dict[str, datetime.datetime]
) -> Iterator[tuple[int, str]]:
    col = -1
    for cell in row:
        reference = cell.get("r")
        col = _column_index(reference) if reference else col + 1
        value = _cell_value(cell, shared, dates)
        if value is not None:
            yield col, value


def _cell_value(
    cell: ElementTree.Element, shared: list[str], dates: dict[str, datetime.datetime]
) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        return "".join(_text(child) for child in cell if _local(child.tag) == "is")
    stored = next((child.text for child in cell if _local(child.tag) == "v"), None)
    if stored is None:
        return None
    if kind == "s":
        return shared[int(stored)]
    if kind == "b":
        return "TRUE" if stored == "1" else "FALSE"
    zero = dates.get(cell.get("s", "")) if kind in (None, "n") else None
    return stored if zero is None else _shown_date(stored, zero)
