"""The test tables as the feeds, bills and activity the library works on."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.checks import raw
from ringledger.operators.staging import staged
from ringledger.plans.feeds import normalise_employees
from ringledger.schemas import CELCOM_HEADERS


@dataclass(frozen=True)
class Inputs:
    """Inputs read lazily from one folder of test tables."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def raw(self, text: str) -> DataFrame:
        names = {name: f"parquet.`{self.folder}/{name}.parquet`" for name in raw.TABLES}
        return self.spark.sql(text.format(millis=raw.SPARK_MILLIS, **names))

    def itemized(self) -> DataFrame:
        return self.raw(raw.ITEMIZED)

    def monthly(self) -> DataFrame:
        return self.raw(raw.MONTHLY)

    def activity(self) -> DataFrame:
        return self.raw(raw.ACTIVITY)

    def employees(self) -> DataFrame:
        """Employee master of the staff list."""
        lines = as_read(self.raw(raw.STAFF_LINES))
        return normalise_employees(lines.select(*[
            text.alias(header) for header, text in _staff_cells().items()
        ]))

    def staff_sheets(self) -> DataFrame:
        """Sheet rows of the staff workbooks, headers in row 3."""
        lines = self.raw(raw.STAFF_LINES)
        headers = list(_staff_cells())
        captions = lines.select("path").distinct().select(
            "path", F.lit(3).alias("row"), _cells(0, [F.lit(name) for name in headers])
        )
        body = lines.select("path", "row", _cells(0, list(_staff_cells().values())))
        return _sheet(captions.unionByName(body), "Master 18", 0)

    def maxis_sheets(self) -> DataFrame:
        """Sheet rows of the MAXIS workbooks."""
        lines = self.raw(raw.MAXIS_LINES).select("path", "row", F.create_map(
            *_numbered({
                1: "contact", 3: "plan_name", 4: "base", 5: "value_added", 6: "usage",
                7: "other", 8: "discount", 12: "total",
            })
        ).alias("cells"))
        statements = self.raw(raw.MAXIS_STATEMENTS)
        dated = statements.select(
            "path", F.lit(2).alias("row"),
            F.create_map(F.lit(3), F.col("period_text")).alias("cells"),
        )
        invoices = statements.select(
            "path", F.lit(9).alias("row"),
            F.create_map(F.lit(6), F.col("account_text")).alias("cells"),
        )
        summary = _sheet(dated.unionByName(lines), "Account Summary", 0)
        return _landed(summary.unionByName(_sheet(invoices, "Tax Invoice", 1)))

    def celcom_sheets(self) -> DataFrame:
        """Sheet rows of the CELCOM workbooks; odd months sit one column further right."""
        shift = (F.col("month_number") % 2).cast("int")
        names = [F.lit(name) for name in CELCOM_HEADERS]
        lines = self.raw(raw.CELCOM_LINES).select(
            "path", "row",
            _cells(1 + shift, [F.col(name) for name in [
                "mobile", "account", "child", "credit_limit", "base", "usage", "one_time",
                "discount", "total",
            ]]),
        )
        statements = self.raw(raw.CELCOM_STATEMENTS)
        captions = statements.select("path", F.lit(14).alias("row"), _cells(1 + shift, names))
        dated = statements.select(
            "path", F.lit(4).alias("row"),
            F.create_map(F.lit(2), F.col("date_text")).alias("cells"),
        )
        parts = [dated, captions, lines]
        return _landed(_sheet(reduce(DataFrame.unionByName, parts), "Bill", 0))


def _landed(sheets: DataFrame) -> DataFrame:
    """Sheet rows written before ranges are cut from them, as the feeds do."""
    return staged(sheets, "sheets")


def as_read(made: DataFrame) -> DataFrame:
    """Made-up text as if it came from a file: what reads it does not repeat its making."""
    return made.select(F.inline(F.array(F.struct(*made.columns))))


def _staff_cells() -> dict[str, Column]:
    return {
        "H/P NO.": F.col("number"),
        "User / Custodian (As per HR list)": F.col("username"),
        "USER": F.col("username"),
        "Phone Model": F.col("phone_model"),
        "Refresh": F.lit("36 months"),
        "Location": F.col("location"),
        "Deliver Date": F.lit("2018"),
        "Provider": F.col("provider"),
        "Type": F.lit("voice"),
        "Custodian": F.col("username"),
        "Cost Center": F.col("cost_center"),
        "Department": F.col("department"),
        "Department HR ": F.col("department"),
        "Title": F.lit("engineer"),
        "Supervisor": F.col("supervisor"),
        "Head Of Department": F.col("head_of_department"),
    }


def _numbered(names: dict[int, str]) -> list[Column]:
    return [part for col, name in names.items() for part in (F.lit(col), F.col(name))]


def _cells(start: Column | int, values: list[Column]) -> Column:
    first = start if isinstance(start, Column) else F.lit(start)
    pairs = [part for i, value in enumerate(values) for part in (first + F.lit(i), value)]
    return F.create_map(*pairs).alias("cells")


def _sheet(rows: DataFrame, name: str, index: int) -> DataFrame:
    return rows.select(
        "path", F.lit(name).alias("sheet"), F.lit(index).alias("sheet_index"), "row", "cells"
    )
