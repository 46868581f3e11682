"""Builds small .xlsx files for the tests."""

import datetime
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"

# Styles 0 to 3: general, a built-in date, a date and a number of the book's own.
STYLES = (
    '<numFmts><numFmt numFmtId="164" formatCode="dd\\ mmm"/>'
    '<numFmt numFmtId="165" formatCode="0.0 &quot;days&quot;"/></numFmts>'
    '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs>'
)


def letters(col: int) -> str:
    name = ""
    col += 1
    while col:
        col, rest = divmod(col - 1, 26)
        name = chr(ord("A") + rest) + name
    return name


def write_workbook(path: Path, sheets: dict[str, dict[int, dict[int, object]]]) -> None:
    """Sheets as {name: {row: {col: value}}}; text is stored shared, numbers as numbers."""
    shared: list[str] = []
    bodies = []
    for rows in sheets.values():
        body = ""
        for row, cells in sorted(rows.items()):
            body += f'<row r="{row + 1}">'
            for col, value in sorted(cells.items()):
                place = f"{letters(col)}{row + 1}"
                if isinstance(value, str):
                    shared.append(value)
                    body += f'<c r="{place}" t="s"><v>{len(shared) - 1}</v></c>'
                elif isinstance(value, datetime.datetime):
                    days = (value - datetime.datetime(1899, 12, 30)) / datetime.timedelta(days=1)
                    body += f'<c r="{place}" s="1"><v>{days}</v></c>'
                elif value is None:
                    body += f'<c r="{place}"/>'
                else:
                    body += f'<c r="{place}"><v>{value}</v></c>'
            body += "</row>"
        bodies.append(f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>')
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        names = "".join(
            f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>'
            for i, name in enumerate(sheets, 1)
        )
        links = "".join(
            f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>'
            for i in range(1, len(sheets) + 1)
        )
        texts = "".join(f"<si><t>{escape(text)}</t></si>" for text in shared)
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{LINKS}"><sheets>{names}</sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{PACKAGE}">{links}</Relationships>',
        )
        book.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN}">{STYLES}</styleSheet>')
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{texts}</sst>')
        for i, body in enumerate(bodies, 1):
            book.writestr(f"xl/worksheets/sheet{i}.xml", body)


def row_of(start: int, values: list) -> dict[int, object]:
    return {start + i: value for i, value in enumerate(values) if value is not None}
