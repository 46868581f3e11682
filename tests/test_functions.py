"""Golden rows and properties of the column expressions."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ringledger.functions import casts, dates, text
from ringledger.schemas import MONTHS

D = dt.date

GOLDEN = [
    (text.null_if_hyphen, {"a-b": None, "ab": "ab", None: None}),
    (text.digits_only, {"+60 12x3": "60123", "abc": "", None: None}),
    (text.bracket_code, {
        "(012)3456789": "012", "0123": None, "x(012)3": "x012", "()5": "", None: None,
    }),
    (text.bracket_tail, {
        "(012)3456789": "3456789", "012": "012", "(012)": None, "(01)2)3": "2",
        "(01))3": "", "(01": "(01", None: None,
    }),
    (text.bracket_tail_strict, {
        "(012)3456789": "3456789", "012": None, "(012)": None, None: None,
    }),
    (text.range_start, {
        "01/02/18 - 05/02/18": "01/02/18 ", "01/02/18": "01/02/18", "-x": "", "-": None,
        None: None,
    }),
    (text.range_end, {
        "01/02/18 - 05/02/18": " 05/02/18", "01/02/18": None, "012-": None, "a-b-c": "b",
        None: None,
    }),
    (text.hyphen_code, {"012-34567890": "012", "012": None, "012-": "012", None: None}),
    (text.hyphen_tail, {
        "012-34567890": "3456789", "012-34": "34", "012": None, "012-": None, None: None,
    }),
    (text.std_code, {"012-3": "012", "012": "null", None: "null"}),
    (text.contact_number, {
        "012-3456789": 3456789, "012-345 67-89": 3456789, "NEW": None, "012-": None,
        None: None,
    }),
    (text.strip_brackets, {"(01)2": "012", "012": "012", None: None}),
    (text.strip_hyphens, {"0-1-2": "012", "012": "012", None: None}),
    (text.account_number, {"No 123456789 X": "123456789", "ab": "", None: None}),
    (dates.short_date, {
        "01/02/18": D(2018, 2, 1), " 05/02/18": D(2018, 2, 5), "31/02/18": None,
        "1/2/18": D(2018, 2, 1), "01/02/98": D(1998, 2, 1), "01/02/2018": D(2018, 2, 1),
        "01/02/18 10:00": D(2018, 2, 1), "2018-02-01": None, "soon": None, "": None,
        "5 x/02/18": None, None: None, "01/02/018": None, "01/02/20181": None, "01 02 18": None,
        "01/02": None, "1/2/3/18": None, "//": None, "01/02/1a": None, "01/02/49": D(2049, 2, 1),
        "01/02/50": D(1950, 2, 1),
    }),
    (dates.statement_date, {
        "05/01/2018 - 28/01/2018": D(2018, 1, 5), "1/2/2018 - 5": D(2018, 2, 1),
        "x": None, None: None,
    }),
    (dates.worded_date, {
        "05 May 2018": D(2018, 5, 5), "5 Jan 2018": D(2018, 1, 5),
        "05 January 2018": D(2018, 1, 5), "May": None, None: None,
    }),
    (dates.cell_date, {
        "2018-05-07": D(2018, 5, 7), "2018-05-07 12:30:00": D(2018, 5, 7), "1905-07-10": D(1905, 7, 10),
        "43227": None, "2018": None, "x": None, None: None,
    }),
    (dates.file_year, {"201805_bill.csv": 2018, "bill.csv": None, None: None}),
    (dates.file_month, {
        "201805_bill.csv": "May", "201813_b.csv": None, "201800_b.csv": None, "x": None,
    }),
    (dates.month_number, {"May": 5, "may": None, "": None, None: None}),
]


@pytest.mark.parametrize("function, rows", GOLDEN, ids=lambda v: getattr(v, "__name__", ""))
def test_golden_rows(function, rows, column):
    assert column(function, list(rows)) == list(rows.values())


def test_hyphen_tail_keeps_all_without_width(column):
    assert column(lambda c: text.hyphen_tail(c, None), ["012-34567890"]) == ["34567890"]


def test_month_names(column):
    assert column(dates.month_name, [0, 1, 12, 13, None], "int") == [
        None, "January", "December", None, None,
    ]
    assert column(dates.month_name_from_zero, [-1, 0, 11, 12], "int") == [
        None, "January", "December", None,
    ]


def test_month_round_trip(column):
    assert column(lambda c: dates.month_name(dates.month_number(c)), MONTHS) == MONTHS


def test_epochs(spark):
    row = spark.range(1).select(
        dates.to_utc_clock(dates.epoch_to_time(F.lit(1383260400000))).alias("begin"),
        dates.to_utc_clock(dates.slot_end(F.lit(1383260400000))).alias("end"),
        dates.unix_seconds(F.lit("1970-01-02 00:00:01.5").cast("timestamp_ntz")).alias("s"),
    ).first()
    assert row["begin"] == dt.datetime(2013, 10, 31, 23, 0)
    assert row["end"] == dt.datetime(2013, 10, 31, 23, 10)
    assert row["s"] == 86401.5


def test_clocks_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        clock = F.lit("2018-03-25 02:30:00").cast("timestamp_ntz")
        there = dates.to_utc_clock(dates.from_utc_clock(clock))
        found = spark.range(1).select(there.cast("string").alias("t")).first()["t"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == "2018-03-25 02:30:00"


PROPERTY = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
DIRTY = st.lists(st.text("0123456789()-/ .,ax", max_size=12), min_size=20, max_size=40)


ODD_NUMBERS = [
    "7", " 7 ", "\t7\n", "+3", "-3", "--3", "12.5", "5.", ".5", ".", "1,200.50", "", " ", "1 2",
    "1e5", "1E-5", "e5", "1.5d", "1.5F", "inf", "-Infinity", "NaN", "nan", "0x1", "n/a",
    "99999999999", "99999999999999999999", None,
]


@PROPERTY
@given(values=st.lists(st.text("0123456789+-. eE,n/a", max_size=8), min_size=1, max_size=40))
def test_numbers_are_those_of_try_cast(values, column):
    values = ODD_NUMBERS + values
    for kind in ("long", "int"):
        wanted = column(lambda c: c.try_cast(kind), values)
        assert column(lambda c: casts.whole(c, kind), values) == wanted


@PROPERTY
@given(values=DIRTY)
def test_dirty_text_never_fails(values, column):
    for function in [
        text.bracket_code, text.bracket_tail, text.range_end, text.hyphen_tail,
        text.contact_number, dates.short_date, dates.statement_date, dates.file_month,
        casts.whole, lambda c: c.try_cast("double"),
    ]:
        assert len(column(function, values)) == len(values)


@PROPERTY
@given(numbers=st.lists(
    st.tuples(st.text("0123456789", min_size=1, max_size=4),
              st.text("0123456789", min_size=1, max_size=9)),
    min_size=1, max_size=30,
))
def test_code_and_tail_make_up_the_number(numbers, column):
    bracketed = [f"({code}){tail}" for code, tail in numbers]
    whole = column(lambda c: F.concat(text.bracket_code(c), text.bracket_tail(c)), bracketed)
    assert whole == [code + tail for code, tail in numbers]


def _pieces(value: str, separator: str) -> list[str]:
    """Pieces between separators, trailing empty ones dropped."""
    pieces = value.split(separator)
    while pieces and pieces[-1] == "":
        pieces.pop()
    return pieces


@PROPERTY
@given(values=DIRTY)
def test_pieces_match_brute_force(values, column):
    second = [
        (p[1] if len(p) > 1 else None) if "-" in v else None
        for v in values
        for p in [_pieces(v, "-")]
    ]
    first = [
        (p[0] if p else None) if "-" in v else v for v in values for p in [_pieces(v, "-")]
    ]
    assert column(text.range_end, values) == second
    assert column(text.range_start, values) == first
