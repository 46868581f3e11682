"""The SQL twin of each query, for an independent engine over the same tables."""

from ringledger.checks import raw
from ringledger.checks.raw import oracle_text as src
from ringledger.schemas import EMPLOYEE_ITEMIZED_BILL, EMPLOYEE_MONTHLY_TOP, MONTHS

_MONTH_LIST = "[" + ", ".join(f"'{name}'" for name in MONTHS) + "]"


def _month_number(name: str) -> str:
    return f"CAST(nullif(coalesce(list_position({_MONTH_LIST}, {name}), 0), 0) AS INT)"


def _month_name(number: str) -> str:
    return f"CASE WHEN {number} BETWEEN 1 AND 12 THEN {_MONTH_LIST}[{number}] END"


def _piece_behind(text: str, separator: str) -> str:
    rest = f"substr({text}, strpos({text}, '{separator}') + 1)"
    return (
        f"CASE WHEN contains({text}, '{separator}') "
        f"AND replace({rest}, '{separator}', '') <> '' "
        f"THEN split_part({text}, '{separator}', 2) END"
    )


def _piece_before(text: str, separator: str) -> str:
    return (
        f"CASE WHEN replace({text}, '{separator}', '') <> '' "
        f"THEN split_part({text}, '{separator}', 1) END"
    )


def _bracketed(text: str) -> str:
    return f"contains({text}, '(') AND contains({text}, ')')"


def _bracket_code(text: str) -> str:
    return (
        f"CASE WHEN {_bracketed(text)} "
        f"THEN replace(split_part({text}, ')', 1), '(', '') END"
    )


def _bracket_tail_strict(text: str) -> str:
    return f"CASE WHEN {_bracketed(text)} THEN {_piece_behind(text, ')')} END"


def _bracket_tail(text: str) -> str:
    return f"CASE WHEN {_bracketed(text)} THEN {_piece_behind(text, ')')} ELSE {text} END"


def _hyphen_code(text: str) -> str:
    return f"CASE WHEN contains({text}, '-') THEN {_piece_before(text, '-')} END"


def _std_code(text: str) -> str:
    return (
        f"CASE WHEN contains({text}, '-') THEN {_piece_before(text, '-')} ELSE 'null' END"
    )


def _contact_number(text: str) -> str:
    rest = f"substr({text}, strpos({text}, '-') + 1)"
    return (
        f"CASE WHEN contains({text}, '-') "
        f"THEN try_cast(regexp_replace({rest}, '[^0-9]', '', 'g') AS BIGINT) END"
    )


def _short_date(text: str) -> str:
    day = f"split_part(trim({text}), ' ', 1)"
    return (
        f"CAST(CASE WHEN regexp_full_match({day}, '[0-9]+/[0-9]+/[0-9]{{2}}') "
        f"THEN try_strptime({day}, '%d/%m/%y') "
        f"WHEN regexp_full_match({day}, '[0-9]+/[0-9]+/[0-9]{{4}}') "
        f"THEN try_strptime({day}, '%d/%m/%Y') END AS DATE)"
    )


def _on_number(column: str, expression: str) -> str:
    return f"SELECT o_orderkey, {column}, {expression} AS result FROM ({src(raw.NUMBERS)})"


def _of_both(select: str) -> str:
    return (
        f"SELECT 'itemized' AS bills, {select.format(bills=src(raw.ITEMIZED))} UNION ALL "
        f"SELECT 'monthly' AS bills, {select.format(bills=src(raw.MONTHLY))}"
    )


def _between_periods(text: str) -> str:
    number = f"billing_year * 12 + {_month_number('billing_month')}"
    return (
        f"SELECT * FROM ({src(text)}) "
        f"WHERE {number} > 2000 * 12 + 10 AND {number} <= 2001 * 12 + 2"
    )


_FILE_YEAR = "try_cast(nullif(regexp_extract(file_name, '^([0-9]{4})([0-9]{2})', 1), '') AS INT)"
_FILE_MONTH = _month_name(
    "try_cast(nullif(regexp_extract(file_name, '^([0-9]{4})([0-9]{2})', 2), '') AS INT)"
)

_ITEMIZED_NORMALISED = f"""
SELECT try_cast({_bracket_tail('"Calling Number"')} AS BIGINT) AS phone_number,
  {_bracket_code('"Calling Number"')} AS STD_code,
  {_short_date('split_part("Date", \'-\', 1)')} AS start_date,
  {_short_date(_piece_behind('"Date"', '-'))} AS end_date,
  "Time" AS time, "Type" AS call_type, "From" AS calling_network, "To" AS called_network,
  "Operator" AS roaming_operator, "PhoneNumber" AS incoming_number,
  try_cast(nullif(regexp_replace("NumberCalled", '[^0-9]', '', 'g'), '') AS BIGINT)
    AS outgoing_number,
  try_cast("Quantity" AS INT) AS quantity, "Size" AS size, "Duration" AS duration,
  CASE WHEN NOT contains("Period", '-') THEN "Period" END AS period,
  CAST("GrossAmount" AS DOUBLE) AS gross_amount, CAST("Discount" AS DOUBLE) AS discount,
  CAST("Total" AS DOUBLE) AS total, "Call Type" AS charges_type,
  {_FILE_MONTH} AS billing_month, {_FILE_YEAR} AS billing_year, 'MAXIS' AS operator
FROM ({src(raw.ITEMIZED_TEXT)})"""

_MAXIS_STATEMENT = f"""
SELECT path, CAST(substr(account_text, 4, 9) AS BIGINT) AS account_number,
  monthname(strptime(substr(period_text, 1, 10), '%d/%m/%Y')) AS billing_month,
  CAST(year(strptime(substr(period_text, 1, 10), '%d/%m/%Y')) AS INT) AS billing_year
FROM ({src(raw.MAXIS_STATEMENTS)})"""

_CELCOM_STATEMENT = f"""
SELECT path, monthname(strptime(date_text, '%d %b %Y')) AS billing_month,
  CAST(year(strptime(date_text, '%d %b %Y')) AS INT) AS billing_year
FROM ({src(raw.CELCOM_STATEMENTS)})"""

_MAXIS_LINES = f"""
SELECT * FROM ({src(raw.MAXIS_LINES)})
WHERE plan_name IS NOT NULL AND base IS NOT NULL AND total IS NOT NULL
  AND try_cast(base AS DOUBLE) IS NOT NULL"""

_MAXIS_NORMALISED = f"""
SELECT 'MAXIS' AS operator,
  try_cast({_bracket_tail_strict('contact')} AS BIGINT) AS phone_number,
  {_bracket_code('contact')} AS STD_code,
  account_number,
  CAST(NULL AS BIGINT) AS employee_account_number,
  CAST(NULL AS DOUBLE) AS credit_limit,
  CAST(base AS DOUBLE) AS base_charges,
  CAST(value_added AS DOUBLE) AS value_added_service,
  CAST(usage AS DOUBLE) AS usage_charges,
  CAST(other AS DOUBLE) AS other_charges,
  CAST(discount AS DOUBLE) AS discount,
  CAST(total AS DOUBLE) AS total,
  billing_month, billing_year
FROM ({_MAXIS_LINES}) JOIN ({_MAXIS_STATEMENT}) USING (path)"""

_CELCOM_NORMALISED = f"""
SELECT 'CELCOM' AS operator,
  try_cast({_piece_behind('mobile', '-')} AS BIGINT) AS phone_number,
  {_hyphen_code('mobile')} AS STD_code,
  CAST(account AS BIGINT) AS account_number,
  try_cast(child AS BIGINT) AS employee_account_number,
  CAST(credit_limit AS DOUBLE) AS credit_limit,
  CAST(base AS DOUBLE) AS base_charges,
  CAST(NULL AS DOUBLE) AS value_added_service,
  CAST(usage AS DOUBLE) AS usage_charges,
  try_cast(one_time AS DOUBLE) AS other_charges,
  CAST(discount AS DOUBLE) AS discount,
  CAST(total AS DOUBLE) AS total,
  billing_month, billing_year
FROM (SELECT * FROM ({src(raw.CELCOM_LINES)})
      WHERE account IS NOT NULL AND trim(credit_limit) <> '')
JOIN ({_CELCOM_STATEMENT}) USING (path)"""

_STAFF = f"""
SELECT {_std_code('number')} AS STD_code,
  {_contact_number('number')} AS contact_number,
  username, phone_model, '36 months' AS refresh, location, '2018' AS deliver_date,
  provider, 'voice' AS type, username AS custodian, username AS user_custodian,
  cost_center, department, department AS department_HR, 'engineer' AS title, supervisor,
  head_of_department
FROM ({src(raw.STAFF_LINES)}) WHERE number <> 'null' AND number <> 'NEW'"""

_STAFF_SIDE = {
    "username", "location", "cost_center", "department", "supervisor",
    "head_of_department", "type",
}


def _mart_columns(names: list[str]) -> str:
    return ", ".join(f"{'staff' if n in _STAFF_SIDE else 'bills'}.{n} AS {n}" for n in names)


_EMPLOYEE_ITEMIZED = f"""
SELECT {_mart_columns(EMPLOYEE_ITEMIZED_BILL.names)}
FROM ({src(raw.ITEMIZED)}) bills JOIN ({_STAFF}) staff
  ON staff.contact_number = bills.phone_number"""

_EMPLOYEE_MONTHLY = f"""
SELECT {', '.join(n for n in EMPLOYEE_MONTHLY_TOP.names)} FROM (
  SELECT DISTINCT bills.*, staff.contact_number,
    staff.STD_code AS staff_code, staff.username, staff.phone_model, staff.refresh,
    staff.location, staff.deliver_date, staff.provider, staff.type, staff.custodian,
    staff.user_custodian, staff.cost_center, staff.department, staff.department_HR,
    staff.title, staff.supervisor, staff.head_of_department
  FROM ({src(raw.MONTHLY)}) bills JOIN ({_STAFF}) staff
    ON staff.contact_number = bills.phone_number)"""

_ACTIVITY_FILLED = f"""
SELECT coalesce(_c0, 0) AS _c0, coalesce(_c1, 0) AS _c1, coalesce(_c2, 0) AS _c2,
  coalesce(_c3, 0) AS _c3, coalesce(_c4, 0) AS _c4, coalesce(_c5, 0) AS _c5,
  coalesce(_c6, 0) AS _c6, coalesce(_c7, 0) AS _c7
FROM ({src(raw.ACTIVITY)})"""

_HOURLY_AVERAGE = f"""
SELECT date_trunc('hour', make_timestamp(_c1 * 1000)) AS start,
  date_trunc('hour', make_timestamp(_c1 * 1000)) + INTERVAL 1 HOUR AS "end",
  CAST(sum(CAST(_c3 AS DECIMAL(18,2)) + CAST(_c4 AS DECIMAL(18,2))
    + CAST(_c5 AS DECIMAL(18,2)) + CAST(_c6 AS DECIMAL(18,2))
    + CAST(_c7 AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS hourly_average
FROM ({_ACTIVITY_FILLED}) GROUP BY 1, 2"""

ORACLE: dict[str, str] = {
    "sheet_range_header": f"""
SELECT path, row, number, username, phone_model, department FROM ({src(raw.STAFF_LINES)})""",
    "sheet_range_positional": f"""
SELECT path, row, contact AS _c0, CAST(NULL AS VARCHAR) AS _c1, plan_name AS _c2,
  base AS _c3, discount AS _c7, total AS _c11
FROM ({src(raw.MAXIS_LINES)})""",
    "sheet_range_empty_as_null": "SELECT path, row, " + ", ".join(
        f"CASE WHEN month_number % 2 = 0 THEN {even} ELSE {odd} END AS _c{i}"
        for i, (even, odd) in enumerate(zip(
            ["mobile", "account", "child", "nullif(trim(credit_limit), '')", "base",
             "usage", "one_time", "discount", "total", "NULL"],
            ["NULL", "mobile", "account", "child", "nullif(trim(credit_limit), '')", "base",
             "usage", "one_time", "discount", "total"],
        ))
    ) + f" FROM ({src(raw.CELCOM_LINES)})",
    "statement_period": f"""
SELECT path, billing_month, billing_year FROM ({_MAXIS_STATEMENT})
UNION ALL SELECT path, billing_month, billing_year FROM ({_CELCOM_STATEMENT})""",
    "account_number_from_cell": f"""
SELECT path, substr(account_text, 4, 9) AS account_number
FROM ({src(raw.MAXIS_STATEMENTS)})""",
    "scan_monthly_all": src(raw.MONTHLY),
    "itemized_by_period": f"""
SELECT * FROM ({src(raw.ITEMIZED)}) WHERE billing_month = 'May' AND billing_year = 1998""",
    "monthly_by_period": f"""
SELECT * FROM ({src(raw.MONTHLY)}) WHERE billing_month = 'May' AND billing_year = 1998""",
    "schema_type_map": f"""
SELECT Field AS field, Type AS source_type,
  CASE WHEN base IN ('int', 'tinyint', 'smallint', 'bigint') THEN 'INTEGER'
       WHEN base IN ('double', 'float', 'decimal') THEN 'FLOAT'
       WHEN base = 'datetime' THEN 'TIMESTAMP' ELSE 'STRING' END AS target_type,
  CASE WHEN "Null" = 'YES' THEN 'NULLABLE' ELSE 'REQUIRED' END AS mode,
  base IN ('int', 'tinyint', 'smallint', 'bigint', 'double', 'float', 'decimal',
           'datetime', 'varchar', 'char', 'text', 'longtext') AS known
FROM (SELECT *, split_part(Type, '(', 1) AS base FROM ({src(raw.DESCRIBED)}))""",
    "empty_seed_union": f"""
SELECT * FROM ({src(raw.MONTHLY)}) WHERE billing_month = 'June' AND billing_year = 1999""",
    "period_from_name": f"""
SELECT o_orderkey, {_FILE_YEAR} AS billing_year, {_FILE_MONTH} AS billing_month
FROM ({src(raw.FILE_NAMES)})""",
    "orc_append_roundtrip": src(raw.MONTHLY),
    "batch_numbering": """
SELECT o_orderkey, o_custkey,
  CAST(ceil(row_number() OVER (ORDER BY o_orderkey) / 1000) AS BIGINT) AS batch_number
FROM orders""",
    "limited_copy": """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_totalprice, o_orderpriority
FROM orders ORDER BY o_orderkey LIMIT 500""",
    "itemized_normalised": _ITEMIZED_NORMALISED,
    "itemized_csv_by_header": f"SELECT * EXCLUDE (file_name) FROM ({src(raw.ITEMIZED_TEXT)})",
    "maxis_monthly_normalised": _MAXIS_NORMALISED,
    "celcom_monthly_normalised": _CELCOM_NORMALISED,
    "employee_master_normalised": _STAFF,
    "bill_header_join": f"""
SELECT path, row, contact AS _c0, account_number, billing_month, billing_year
FROM ({_MAXIS_LINES}) JOIN ({_MAXIS_STATEMENT}) USING (path)""",
    "feed_row_counts": f"""
SELECT 'monthly' AS feed, operator, count(*) AS row_count
FROM (SELECT operator FROM ({_MAXIS_NORMALISED})
      UNION ALL SELECT operator FROM ({_CELCOM_NORMALISED})) GROUP BY operator
UNION ALL SELECT 'itemized' AS feed, operator, count(*) AS row_count
FROM ({_ITEMIZED_NORMALISED}) GROUP BY operator""",
    "filter_not_null_all": f"""
SELECT path, row, contact AS _c0, base AS _c3, total AS _c11 FROM ({src(raw.MAXIS_LINES)})
WHERE plan_name IS NOT NULL AND base IS NOT NULL AND total IS NOT NULL""",
    "filter_castable": f"""
SELECT path, row, CAST(base AS DOUBLE) AS base_charges FROM ({_MAXIS_LINES})""",
    "employee_placeholder_filter": f"""
SELECT number, username FROM ({src(raw.STAFF_LINES)})
WHERE number <> 'null' AND number <> 'NEW'""",
    "fn_null_if_hyphen": _on_number(
        "hyphenated", "CASE WHEN NOT contains(hyphenated, '-') THEN hyphenated END"
    ),
    "fn_digits_only": _on_number(
        "bracketed", "regexp_replace(bracketed, '[^0-9]', '', 'g')"
    ),
    "fn_bracket_code": _on_number("bracketed", _bracket_code("bracketed")),
    "fn_bracket_tail": _on_number("bracketed", _bracket_tail("bracketed")),
    "fn_bracket_tail_strict": _on_number("bracketed", _bracket_tail_strict("bracketed")),
    "fn_range_start": _on_number(
        "hyphenated",
        f"CASE WHEN contains(hyphenated, '-') THEN {_piece_before('hyphenated', '-')} "
        "ELSE hyphenated END",
    ),
    "fn_range_end": _on_number("hyphenated", _piece_behind("hyphenated", "-")),
    "fn_hyphen_code": _on_number("hyphenated", _hyphen_code("hyphenated")),
    "fn_hyphen_tail7": _on_number(
        "hyphenated", f"substr({_piece_behind('hyphenated', '-')}, 1, 7)"
    ),
    "fn_std_code": _on_number("hyphenated", _std_code("hyphenated")),
    "fn_strip_brackets": _on_number(
        "bracketed", "replace(replace(bracketed, '(', ''), ')', '')"
    ),
    "fn_strip_hyphens": _on_number("hyphenated", "replace(hyphenated, '-', '')"),
    "fn_parse_short_date": f"""
SELECT l_orderkey, l_linenumber, day_text, {_short_date('day_text')} AS result
FROM ({src(raw.SHIP_DATES)})""",
    "fn_month_number": f"""
SELECT o_orderkey, month_text, {_month_number('month_text')} AS result
FROM ({src(raw.MONTH_TEXTS)})""",
    "fn_month_name": f"""
SELECT o_orderkey, {_month_name('month_index')} AS from_one,
  {_month_name('(month_index + 1)')} AS from_zero
FROM ({src(raw.MONTH_TEXTS)})""",
    "fn_try_cast": f"""
SELECT o_orderkey, try_cast(whole AS BIGINT) AS as_long, try_cast(whole AS INT) AS as_int,
  try_cast(money AS DOUBLE) AS as_double, try_cast(day AS DATE) AS as_date
FROM ({src(raw.NUMBERS)})""",
    "fn_unix_seconds": "SELECT event_id, epoch_us(ts) / 1e6 AS seconds FROM events",
    "max_billing_year": _of_both("max(billing_year) AS max_year FROM ({bills})"),
    "max_billing_month_in_year": _of_both(
        f"coalesce(max({_month_number('billing_month')}), 0) AS max_month "
        "FROM ({bills}) WHERE billing_year = 2001"
    ) + f""" UNION ALL SELECT 'no such year' AS bills,
coalesce(max({_month_number('billing_month')}), 0) AS max_month
FROM ({src(raw.MONTHLY)}) WHERE billing_year = 1990""",
    "high_watermark_period": _of_both(
        "billing_year * 12 + m AS billing_period, billing_year AS max_year, m AS max_month "
        f"FROM (SELECT billing_year, max({_month_number('billing_month')}) AS m "
        "FROM ({bills}) GROUP BY billing_year ORDER BY billing_year DESC LIMIT 1)"
    ),
    "months_of_year": _of_both(
        "billing_month FROM (SELECT DISTINCT billing_month FROM ({bills}) "
        "WHERE billing_year = 2001)"
    ),
    "itemized_incremental": _between_periods(raw.ITEMIZED),
    "monthly_incremental": _between_periods(raw.MONTHLY),
    "full_load_when_no_state": src(raw.MONTHLY),
    "employee_itemized_bill": _EMPLOYEE_ITEMIZED,
    "employee_monthly_top": _EMPLOYEE_MONTHLY,
    "monthly_union_operators": f"{_MAXIS_NORMALISED} UNION ALL {_CELCOM_NORMALISED}",
    "activity_null_fill": _ACTIVITY_FILLED,
    "activity_cleaned": f"""
SELECT _c0 AS square_id, make_timestamp(_c1 * 1000) AS beginning_time,
  make_timestamp((_c1 + 600000) * 1000) AS end_time, 10 AS time_interval,
  _c2 AS country_code, _c3 AS SMS_in_activity, _c4 AS SMS_out_activity,
  _c5 AS call_in_activity, _c6 AS call_out_activity, _c7 AS internet_traffic_activity
FROM ({_ACTIVITY_FILLED})""",
    "hourly_average_activity": f"{_HOURLY_AVERAGE} ORDER BY start",
    "peak_hour": f"""
SELECT start, "end", hourly_average FROM ({_HOURLY_AVERAGE})
ORDER BY hourly_average DESC, start LIMIT 1""",
    "hourly_internet_by_square": f"""
SELECT date_trunc('hour', make_timestamp(_c1 * 1000)) AS start,
  date_trunc('hour', make_timestamp(_c1 * 1000)) + INTERVAL 1 HOUR AS "end",
  _c0 AS square_id,
  CAST(sum(CAST(_c7 AS DECIMAL(18,2))) AS DOUBLE) AS hourly_internet_usage
FROM ({_ACTIVITY_FILLED}) GROUP BY 1, 2, 3 ORDER BY 1, 3""",
    "stream_hourly_activity": _HOURLY_AVERAGE,
    "stream_hourly_late_rows": f"""
WITH slots AS ({src(raw.ACTIVITY)}), span AS (SELECT min(_c1) AS low, max(_c1) AS high FROM slots),
arriving AS (
  SELECT coalesce(4 * (_c1 - low) // (high + 1 - low), 0)
      + CASE WHEN _c0 % 16 = 0 THEN 1 ELSE 0 END AS turn,
    coalesce(_c1, 0) AS millis,
    CAST(coalesce(_c3, 0) AS DECIMAL(18,2)) + CAST(coalesce(_c4, 0) AS DECIMAL(18,2))
      + CAST(coalesce(_c5, 0) AS DECIMAL(18,2)) + CAST(coalesce(_c6, 0) AS DECIMAL(18,2))
      + CAST(coalesce(_c7, 0) AS DECIMAL(18,2)) AS total
  FROM slots, span
), newest AS (SELECT turn, max(millis) AS newest FROM arriving GROUP BY turn
), bounds AS (
  SELECT turn, max(newest) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - 7200000 AS bound FROM newest
), told AS (
  SELECT date_trunc('hour', make_timestamp(millis * 1000)) AS start, total,
    coalesce((millis // 3600000 + 1) * 3600000 <= bound, false) AS late
  FROM arriving JOIN bounds USING (turn)
)
SELECT start, start + INTERVAL 1 HOUR AS "end",
  CAST(sum(total) FILTER (NOT late) AS DOUBLE) / count(*) FILTER (NOT late) AS hourly_average,
  CAST(count(*) FILTER (NOT late) AS BIGINT) AS n_rows, CAST(count(*) FILTER (late) AS BIGINT) AS n_late
FROM told GROUP BY 1, 2""",
}
