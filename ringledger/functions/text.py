"""Phone-number and range text as built-in column expressions.

Every function takes and returns a Column, is NULL-safe, never fails a task on odd text,
and stays inside whole-stage code generation.

A "piece" is what lies between separators. Empty pieces at the end of the text do not
exist, so ``012-`` has a first piece and no second one, while ``012--9`` has an empty
second piece.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringledger.functions.casts import whole


def _has_brackets(text: Column) -> Column:
    return text.contains("(") & text.contains(")")


def _first_piece(text: Column, separator: str) -> Column:
    only_separators = F.translate(text, separator, "") == ""
    return F.when(~only_separators, F.substring_index(text, separator, 1))


def _after_first(text: Column, separator: str) -> Column:
    return F.substr(text, F.instr(text, separator) + 1)


def _second_piece(text: Column, separator: str) -> Column:
    """Second piece of text that is known to hold the separator."""
    rest = _after_first(text, separator)
    only_separators = F.translate(rest, separator, "") == ""
    return F.when(~only_separators, F.substring_index(rest, separator, 1))


def null_if_hyphen(text: Column) -> Column:
    """Text without any hyphen; NULL otherwise."""
    return F.when(~text.contains("-"), text)


def digits_only(text: Column) -> Column:
    """Only the digits 0-9, possibly none."""
    return F.regexp_replace(text, "[^0-9]", "")


def bracket_code(text: Column) -> Column:
    """Dialling code before the first closing bracket; NULL without a bracket pair."""
    return F.when(
        _has_brackets(text), F.translate(F.substring_index(text, ")", 1), "(", "")
    )


def bracket_tail(text: Column) -> Column:
    """Number behind the bracketed code; text without a bracket pair stays as it is."""
    return F.when(_has_brackets(text), _second_piece(text, ")")).otherwise(text)


def bracket_tail_strict(text: Column) -> Column:
    """Number behind the bracketed code; NULL without a bracket pair."""
    return F.when(_has_brackets(text), _second_piece(text, ")"))


def range_start(text: Column) -> Column:
    """First end of ``a - b``; text without a hyphen stays as it is."""
    return F.when(text.contains("-"), _first_piece(text, "-")).otherwise(text)


def range_end(text: Column) -> Column:
    """Second end of ``a - b``; NULL without one."""
    return F.when(text.contains("-"), _second_piece(text, "-"))


def hyphen_code(text: Column) -> Column:
    """Dialling code before the first hyphen; NULL without a hyphen."""
    return F.when(text.contains("-"), _first_piece(text, "-"))


def hyphen_tail(text: Column, width: int | None = 7) -> Column:
    """Number behind the first hyphen, cut to ``width`` characters (None keeps all)."""
    tail = range_end(text)
    return tail if width is None else F.substring(tail, 1, width)


def std_code(text: Column) -> Column:
    """Dialling code before the first hyphen, or the word ``null`` when there is none."""
    return F.when(text.contains("-"), _first_piece(text, "-")).otherwise(F.lit("null"))


def contact_number(text: Column) -> Column:
    """All digits behind the first hyphen as a LONG, comparable with a bill's phone number."""
    digits = F.when(text.contains("-"), digits_only(_after_first(text, "-")))
    return whole(digits)


def strip_brackets(text: Column) -> Column:
    """Text without round brackets."""
    return F.translate(text, "()", "")


def strip_hyphens(text: Column) -> Column:
    """Text without hyphens."""
    return F.translate(text, "-", "")


def account_number(cell: Column) -> Column:
    """The nine characters of an invoice cell that hold the account number."""
    return F.substring(cell, 4, 9)
