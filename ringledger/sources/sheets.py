"""Rectangles of a sheet, cut out of a table of sheet rows.

``rows`` has one row per filled sheet row: path, sheet, sheet_index, row and ``cells``, a
map from column index to text; rows and columns count from zero. A range takes the
inclusive columns ``start`` to ``end`` of the rows from ``skip`` on; sheet None means the
first sheet of each file. Cutting a range is a filter and a projection, no shuffle.

A feed cuts several ranges, so land the rows as Parquet (``staged``) first: files are
then unpacked once, and the sheet and row filters reach the scan.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.operators.joins import join_per_file


def _on_range(sheet: str | None, skip: int) -> Column:
    on_sheet = F.col("sheet_index") == 0 if sheet is None else F.col("sheet") == sheet
    return on_sheet & (F.col("row") >= skip)


def _cell(position: Column, empty_as_null: bool) -> Column:
    value = F.try_element_at("cells", position)
    return F.when(F.trim(value) != "", value) if empty_as_null else value


def _captioned(name: str) -> Column:
    return F.get(F.filter("_captions", lambda cell: cell["value"] == name), F.lit(0))["key"]


def sheet_range(
    rows: DataFrame,
    sheet: str | None,
    start: int,
    end: int,
    skip: int,
    empty_as_null: bool = False,
) -> DataFrame:
    """Headerless range: path, row and positional text columns ``_c0``, ``_c1``, ..."""
    columns = [
        _cell(F.lit(start + i), empty_as_null).alias(f"_c{i}")
        for i in range(end - start + 1)
    ]
    return rows.where(_on_range(sheet, skip)).select("path", "row", *columns)


def sheet_range_with_header(
    rows: DataFrame,
    sheet: str | None,
    start: int,
    end: int,
    skip: int,
    names: list[str],
    empty_as_null: bool = False,
    per_file: DataFrame | None = None,
) -> DataFrame:
    """Range whose first row names the columns: path, row and the columns in ``names``.

    Each file is read by its own header row, so the same column may sit elsewhere in
    another file. Where a file's header lacks a name, that column is NULL, and without a
    header row all are; ``lacking`` tells such files. ``per_file``, one row per path, adds
    its columns.

    The headers, one row of column indexes per file, meet the rows together with
    ``per_file``, so the rows are joined once.
    """
    inside = rows.where(_on_range(sheet, skip))
    captions = F.filter(
        F.map_entries("cells"), lambda cell: cell["key"].between(start, end)
    )
    positions = [_captioned(name).alias(f"_at{i}") for i, name in enumerate(names)]
    header = (
        inside.where(F.col("row") == skip)
        .select("path", captions.alias("_captions"))
        .select("path", *positions)
    )
    columns = [
        _cell(F.col(f"_at{i}"), empty_as_null).alias(name) for i, name in enumerate(names)
    ]
    if per_file is not None:
        columns += [F.col(name) for name in per_file.columns if name != "path"]
        header = header.join(per_file, "path", "left")
    body = inside.where(F.col("row") > skip)
    return join_per_file(body, header, "left").select("path", "row", *columns)


def lacking(
    rows: DataFrame,
    sheet: str | None,
    start: int,
    end: int,
    skip: int,
    names: list[str] | None = None,
) -> DataFrame:
    """Paths of the files that lack the sheet, or a header row with all of ``names``."""
    on_sheet = F.col("sheet_index") == 0 if sheet is None else F.col("sheet") == sheet
    good = on_sheet
    if names:
        inside = F.map_filter("cells", lambda col, _: col.between(start, end))
        held = F.map_values(inside)
        good = on_sheet & (F.col("row") == skip) & F.forall(
            F.array(*[F.lit(name) for name in names]), lambda name: F.array_contains(held, name)
        )
    return rows.groupBy("path").agg(F.bool_or(good).alias("good")).where(
        ~F.coalesce("good", F.lit(False))
    ).select("path")


def first_cells(rows: DataFrame, **wanted: tuple[str | None, int, int]) -> DataFrame:
    """Topmost filled cell of some columns per file.

    Each keyword gives the (sheet, column, rows to skip) to look in and names the result
    column beside path. NULL where a file has no such cell.

    The rows to look at come from a hash aggregate over row numbers; text is only read
    from those rows.
    """
    found, tops, cells = F.lit(False), [], {}
    for name, (sheet, col, skip) in wanted.items():
        value = F.try_element_at("cells", F.lit(col))
        here = _on_range(sheet, skip) & value.isNotNull()
        found = found | here
        tops.append(F.min(F.when(here, F.col("row"))).alias(f"_top_{name}"))
        cells[name] = rows.where(here).select("path", F.col("row").alias(f"_top_{name}"),
                                              value.alias(name))
    result = rows.where(found).groupBy("path").agg(*tops)
    for name, of_file in cells.items():
        result = result.join(of_file, ["path", f"_top_{name}"], "left")
    return result.select("path", *cells)
