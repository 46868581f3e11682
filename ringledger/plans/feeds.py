"""Bill and staff feeds normalised to the shared table schemas.

Every function is DataFrame in, DataFrame out over all files of a feed at once.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ringledger.functions import casts, dates, text
from ringledger.operators.joins import join_per_file
from ringledger.schemas import (
    CELCOM,
    CELCOM_HEADERS,
    EMPLOYEE_HEADERS,
    EMPLOYEE_MASTER,
    ITEMIZED_BILL,
    MAXIS,
    MONTHLY_BILL_SUMMARY,
)
from ringledger.sources.sheets import first_cells, sheet_range, sheet_range_with_header

# Where the workbooks keep their ranges (sheet, columns, rows to skip).
EMPLOYEE_SHEET = "Master 18"
EMPLOYEE_RANGE = (EMPLOYEE_SHEET, 0, 20, 3)
MAXIS_SUMMARY_RANGE = ("Account Summary", 1, 12, 6)
CELCOM_BILL_RANGE = (None, 1, 99, 14)

# Columns whose topmost filled cell dates or numbers a statement (sheet,
# column, rows to skip).
MAXIS_DATE_CELL = ("Account Summary", 3, 0)
MAXIS_ACCOUNT_CELL = ("Tax Invoice", 6, 6)
CELCOM_DATE_CELL = (None, 2, 4)


def _wanted(*places: tuple) -> dict[str | None, int]:
    """The first row wanted of each sheet that ranges (sheet, first and last column, rows to skip)
    or cells (sheet, column, rows to skip) lie on."""
    found: dict[str | None, int] = {}
    for sheet, *_, skip in places:
        found[sheet] = min(skip, found.get(sheet, skip))
    return found


# What is unpacked of each feed's workbooks.
EMPLOYEE_SHEETS = _wanted(EMPLOYEE_RANGE)
MAXIS_SHEETS = _wanted(MAXIS_SUMMARY_RANGE, MAXIS_DATE_CELL, MAXIS_ACCOUNT_CELL)
CELCOM_SHEETS = _wanted(CELCOM_BILL_RANGE, CELCOM_DATE_CELL)

# The staff list's number column, quoted as its header ends in a dot.
STAFF_NUMBER = "`H/P NO.`"

# Staff without a number of their own.
PLACEHOLDER_NUMBERS = ["null", "NEW"]


def _laid_out(df: DataFrame, schema: StructType, columns: dict[str, Column]) -> DataFrame:
    """Selects the schema's columns, text that does not fit its type becoming NULL."""
    return df.select(*[
        columns[field.name].try_cast(field.dataType).alias(field.name) for field in schema
    ])


def normalise_itemized(raw: DataFrame, operator: str = MAXIS) -> DataFrame:
    """Itemized bills from CSV columns plus ``file_name``, which dates the bill."""
    number = F.col("Calling Number")
    # Both ends get a projection of their own: parsing reads each of them several times.
    ends = raw.select(
        "*",
        text.range_start(F.col("Date")).alias("_start"),
        text.range_end(F.col("Date")).alias("_end"),
    )
    return _laid_out(ends, ITEMIZED_BILL, {
        "phone_number": casts.whole(text.bracket_tail(number)),
        "STD_code": text.bracket_code(number),
        "start_date": dates.short_date(F.col("_start")),
        "end_date": dates.short_date(F.col("_end")),
        "time": F.col("Time"),
        "call_type": F.col("Type"),
        "calling_network": F.col("From"),
        "called_network": F.col("To"),
        "roaming_operator": F.col("Operator"),
        "incoming_number": F.col("PhoneNumber"),
        "outgoing_number": casts.whole(text.digits_only(F.col("NumberCalled"))),
        "quantity": casts.whole(F.col("Quantity"), "int"),
        "size": F.col("Size"),
        "duration": F.col("Duration"),
        "period": text.null_if_hyphen(F.col("Period")),
        "gross_amount": F.col("GrossAmount"),
        "discount": F.col("Discount"),
        "total": F.col("Total"),
        "charges_type": F.col("Call Type"),
        "billing_month": dates.file_month(F.col("file_name")),
        "billing_year": dates.file_year(F.col("file_name")),
        "operator": F.lit(operator),
    })


def maxis_statement(rows: DataFrame) -> DataFrame:
    """One row per MAXIS workbook: path, account_number, billing_month, billing_year.

    A workbook that lacks the invoice or date cell keeps its row, with NULL there.
    """
    cells = first_cells(rows, _date=MAXIS_DATE_CELL, _account=MAXIS_ACCOUNT_CELL)
    cell = F.col("_date")
    day = F.coalesce(dates.statement_date(cell), dates.cell_date(cell))
    return cells.select(
        "path",
        text.account_number(F.col("_account")).try_cast("long").alias("account_number"),
        dates.month_name(F.month(day)).alias("billing_month"),
        F.year(day).alias("billing_year"),
    )


def celcom_statement(rows: DataFrame) -> DataFrame:
    """One row per CELCOM workbook: path, billing_month, billing_year."""
    cell = F.col("_date")
    day = F.coalesce(dates.worded_date(cell), dates.cell_date(cell))
    return first_cells(rows, _date=CELCOM_DATE_CELL).select(
        "path",
        dates.month_name(F.month(day)).alias("billing_month"),
        F.year(day).alias("billing_year"),
    )


def maxis_bill_lines(rows: DataFrame) -> DataFrame:
    """Bill lines of the MAXIS summary, without captions, footers and text rows."""
    lines = sheet_range(rows, *MAXIS_SUMMARY_RANGE)
    return lines.where(
        F.col("_c2").isNotNull()
        & F.col("_c3").isNotNull()
        & F.col("_c11").isNotNull()
        & F.col("_c3").try_cast("double").isNotNull()
    )


def with_statement(lines: DataFrame, statement: DataFrame) -> DataFrame:
    """Adds each file's statement values to its bill lines.

    Lines of a file without any statement cell stay, undated.
    """
    return join_per_file(lines, statement, "left")


def normalise_maxis_monthly(rows: DataFrame) -> DataFrame:
    """MAXIS monthly bills from the sheet rows of their workbooks."""
    lines = with_statement(maxis_bill_lines(rows), maxis_statement(rows))
    return _laid_out(lines, MONTHLY_BILL_SUMMARY, {
        "operator": F.lit(MAXIS),
        "phone_number": casts.whole(text.bracket_tail_strict(F.col("_c0"))),
        "STD_code": text.bracket_code(F.col("_c0")),
        "account_number": F.col("account_number"),
        "employee_account_number": F.lit(None),
        "credit_limit": F.lit(None),
        "base_charges": F.col("_c3"),
        "value_added_service": F.col("_c4"),
        "usage_charges": F.col("_c5"),
        "other_charges": F.col("_c6"),
        "discount": F.col("_c7"),
        "total": F.col("_c11"),
        "billing_month": F.col("billing_month"),
        "billing_year": F.col("billing_year"),
    })


def normalise_celcom_monthly(
    rows: DataFrame, missing_as_nan: bool = False, number_width: int | None = None
) -> DataFrame:
    """CELCOM monthly bills from the sheet rows of their workbooks.

    These bills have no value-added charge: NULL, or NaN with ``missing_as_nan``. Numbers
    keep all their digits, as those of the staff list do; ``number_width`` cuts them.
    """
    lines = sheet_range_with_header(
        rows, *CELCOM_BILL_RANGE, CELCOM_HEADERS, empty_as_null=True,
        per_file=celcom_statement(rows),
    ).where(F.col("Account No").isNotNull() & F.col("Credit Limit").isNotNull())
    number = F.col("Mobile No")
    return _laid_out(lines, MONTHLY_BILL_SUMMARY, {
        "operator": F.lit(CELCOM),
        "phone_number": casts.whole(text.hyphen_tail(number, number_width)),
        "STD_code": text.hyphen_code(number),
        "account_number": casts.whole(F.col("Account No")),
        "employee_account_number": casts.whole(F.col("Child Account No")),
        "credit_limit": F.col("Credit Limit"),
        "base_charges": F.col("Monthly Charges"),
        "value_added_service": F.lit(float("nan") if missing_as_nan else None),
        "usage_charges": F.col("Usage Call/Charges"),
        "other_charges": F.col("One Time Charges"),
        "discount": F.col("Discount and Rebates"),
        "total": F.col("Current Charges (Excl Tax)"),
        "billing_month": F.col("billing_month"),
        "billing_year": F.col("billing_year"),
    })


def employee_rows(rows: DataFrame) -> DataFrame:
    """Staff list under its own headers, empty cells kept as empty text."""
    return sheet_range_with_header(rows, *EMPLOYEE_RANGE, EMPLOYEE_HEADERS)


def without_placeholders(staff: DataFrame) -> DataFrame:
    """Staff rows that carry a real number."""
    number = F.col(STAFF_NUMBER)
    wanted = number.isNotNull()
    for placeholder in PLACEHOLDER_NUMBERS:
        wanted = wanted & (number != placeholder)
    return staff.where(wanted)


def normalise_employees(staff: DataFrame, keep_placeholders: bool = False) -> DataFrame:
    """Employee master from the headered staff list."""
    if not keep_placeholders:
        staff = without_placeholders(staff)
    number = F.col(STAFF_NUMBER)
    return _laid_out(staff, EMPLOYEE_MASTER, {
        "STD_code": text.std_code(number),
        "contact_number": text.contact_number(number),
        "username": F.col("USER"),
        "phone_model": F.col("Phone Model"),
        "refresh": F.col("Refresh"),
        "location": F.col("Location"),
        "deliver_date": F.col("Deliver Date"),
        "provider": F.col("Provider"),
        "type": F.col("Type"),
        "custodian": F.col("Custodian"),
        "user_custodian": F.col("User / Custodian (As per HR list)"),
        "cost_center": F.col("Cost Center"),
        "department": F.col("Department"),
        "department_HR": F.col("Department HR "),
        "title": F.col("Title"),
        "supervisor": F.col("Supervisor"),
        "head_of_department": F.col("Head Of Department"),
    })
