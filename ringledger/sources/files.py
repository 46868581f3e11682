"""Delimited feed files."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.operators.joins import join_per_file
from ringledger.operators.staging import staged
from ringledger.schemas import ACTIVITY_TSV, ITEMIZED_CSV


def csv_lines(raw: DataFrame) -> DataFrame:
    """``path``, ``file_name``, ``modified`` and ``line`` of every filled line of text files."""
    return raw.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("line"),
    ).where(F.btrim("line", F.lit(" \t")) != "")


def _of_cells(width: int, body: Callable[[Column], Column]) -> Column:
    """``body`` of the cells of ``line``, which is cut once however often ``body`` uses them."""
    columns = [f"_c{i}" for i in range(width)]
    cut = F.from_csv("line", ", ".join(f"{name} STRING" for name in columns))
    cells = F.transform(F.array(cut), lambda x: F.array(*[x[name] for name in columns]))
    return F.get(F.transform(cells, body), F.lit(0))


def headers(lines: DataFrame, names: list[str]) -> tuple[DataFrame, int]:
    """``path, _at``: where each file's header line has the named columns, counted from 1; and the
    number of cells of the widest header.

    A header line is one that holds all names. Lines are looked through once, as text; header
    lines alone are cut into cells.
    """
    named = F.lit(True)
    for name in names:
        named = named & F.col("line").contains(name)
    found = staged(lines.where(named).select("path", "line"), "header-lines")
    # Never below the number of cells: a quoted comma counts as one more.
    width = found.agg(F.max(F.size(F.split("line", ",")))).first()[0] or 1
    places = _of_cells(width, lambda cells: F.array(
        *[F.array_position(cells, name).cast("int") for name in names]
    ))
    whole = found.select("path", places.alias("_at")).where(F.forall("_at", lambda at: at > 0))
    return whole.groupBy("path").agg(F.max("_at").alias("_at")), width


def headless(lines: DataFrame, names: list[str]) -> DataFrame:
    """``path, modified`` of the files without a header line."""
    files = lines.select("path", "modified").distinct()
    return files.join(headers(lines, names)[0], "path", "left_anti")


def by_own_header(
    lines: DataFrame, names: list[str], skip_headless: bool = False
) -> DataFrame:
    """Lines under the named columns, each file read by its own header line.

    Files may carry more columns, in any order and number. A file without a header line raises,
    with its path, or is left out with ``skip_headless``. Lines stay where they are read unless the headers of all files outgrow
    Spark's broadcast threshold.
    """
    placed, width = headers(lines, names)
    body = join_per_file(lines, placed, "inner" if skip_headless else "left")
    message = F.concat(F.lit("no header line with the needed columns: "), F.col("path"))
    at = F.coalesce("_at", F.raise_error(message).cast("array<int>"))
    picked = _of_cells(width, lambda cells: F.transform(at, lambda k: F.get(cells, k - 1)))
    caption = F.array(*[F.lit(name) for name in names])
    # Exploded, so that no later filter has lines cut once more.
    told = body.select("file_name", F.explode(F.filter(
        F.array(picked), lambda cells: ~cells.eqNullSafe(caption)
    )).alias("_picked"))
    return told.select(*[F.get("_picked", F.lit(i)).alias(n) for i, n in enumerate(names)], "file_name")


def read_itemized_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Itemized bills as text columns named by each file's header, plus ``file_name``."""
    return by_own_header(csv_lines(spark.read.text(path)), ITEMIZED_CSV.names)


def read_activity_tsv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headerless activity export with its eight columns typed by declaration."""
    return spark.read.schema(ACTIVITY_TSV).option("sep", "\t").csv(path)
