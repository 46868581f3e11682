"""Feed-shaped inputs derived from the test tables.

Each text is plain SQL that Spark and the SQL oracle both run; ``{orders}`` and the like
stand for the tables. Dirty cases (missing separators, empty pieces, text in number
columns, impossible dates) come from the keys, so they are spread over all rows.
"""

from ringledger.schemas import MONTHS

TABLES = ["region", "nation", "customer", "part", "orders", "lineitem", "events"]


def _month_name(month: str) -> str:
    # Cut out of one text: far less generated code than a case per month.
    names = "".join(name.ljust(9) for name in MONTHS)
    return f"trim(substr('{names}', 9 * {month} - 8, 9))"


def _two(number: str) -> str:
    return f"lpad(CAST({number} AS STRING), 2, '0')"


def _money(amount: str) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(18,2)) AS STRING)"


_ORDER_MONTH = "CAST(month(o_orderdate) AS INT)"
_ORDER_YEAR = "CAST(year(o_orderdate) AS INT)"
_FILE_MONTH = f"CAST({_ORDER_YEAR} AS STRING) || {_two(_ORDER_MONTH)}"
_CUSTOMER = "CAST(o_custkey AS STRING)"


def _phone(key: str) -> str:
    """A customer's number: eight digits for some, of which seven may be another's."""
    return f"(CASE WHEN {key} % 7 = 0 THEN {key} * 100000 + 7 ELSE {key} END)"

# Lines with their ship date as ``yyyy-MM-dd`` text, and that text as ``dd/MM/yy``.
_LINES = (
    "(SELECT *, CAST(CAST(l_shipdate AS DATE) AS STRING) AS shipped FROM {lineitem}) lines"
)
_DAY, _MONTH, _YEAR = "substr(shipped, 9, 2)", "substr(shipped, 6, 2)", "substr(shipped, 1, 4)"
_SHORT_DATE = f"{_DAY} || '/' || {_MONTH} || '/' || substr(shipped, 3, 2)"

# Orders with their date as ``yyyy-MM-dd`` text, and its ``yyyyMM``.
_DATED_ORDERS = (
    "(SELECT *, CAST(CAST(o_orderdate AS DATE) AS STRING) AS ordered FROM {orders}) dated"
)
_ORDERED_MONTH = "substr(ordered, 1, 4) || substr(ordered, 6, 2)"

# One number text per order: with brackets, with hyphens, and everything in between.
NUMBERS = f"""
SELECT o_orderkey,
  CASE o_orderkey % 8
    WHEN 0 THEN NULL
    WHEN 1 THEN '(0' || {_CUSTOMER} || ')'
    WHEN 2 THEN {_CUSTOMER}
    WHEN 3 THEN 'x(012)' || {_CUSTOMER}
    WHEN 4 THEN '(012))' || {_CUSTOMER}
    WHEN 5 THEN '(012)' || {_CUSTOMER} || ')9'
    WHEN 6 THEN '(012' || {_CUSTOMER}
    ELSE '(012)' || {_CUSTOMER} END AS bracketed,
  CASE o_orderkey % 8
    WHEN 0 THEN NULL
    WHEN 1 THEN '012-'
    WHEN 2 THEN {_CUSTOMER}
    WHEN 3 THEN '-' || {_CUSTOMER}
    WHEN 4 THEN '012--' || {_CUSTOMER}
    WHEN 5 THEN '012-' || {_CUSTOMER} || '-9'
    WHEN 6 THEN '--'
    ELSE '012-' || CAST(34567890000 + o_custkey AS STRING) END AS hyphenated,
  CASE o_orderkey % 6
    WHEN 0 THEN NULL
    WHEN 1 THEN 'abc'
    WHEN 2 THEN '1,200.50'
    WHEN 3 THEN ' ' || {_CUSTOMER} || ' '
    WHEN 4 THEN ''
    ELSE '-' || {_CUSTOMER} END AS whole,
  CASE o_orderkey % 4
    WHEN 0 THEN NULL
    WHEN 1 THEN 'n/a'
    ELSE {_money('o_totalprice')} END AS money,
  CASE o_orderkey % 4
    WHEN 0 THEN '2018-02-31'
    WHEN 1 THEN 'soon'
    ELSE CAST({_ORDER_YEAR} AS STRING) || '-' || {_two(_ORDER_MONTH)} || '-01' END AS day
FROM {{orders}}"""

# One ship date text per line; cases 2 and 6 to 8 are no dates, cases 1, 3, 5 and 9 have
# two-digit years.
SHIP_DATES = f"""
SELECT l_orderkey, l_linenumber,
  CASE (l_orderkey + l_linenumber) % 10
    WHEN 0 THEN NULL
    WHEN 1 THEN ' ' || {_SHORT_DATE} || ' '
    WHEN 2 THEN '31/02/' || substr(shipped, 3, 2)
    WHEN 3 THEN CAST(CAST({_DAY} AS INT) AS STRING) || '/'
                || CAST(CAST({_MONTH} AS INT) AS STRING) || '/' || substr(shipped, 3, 2)
    WHEN 4 THEN {_DAY} || '/' || {_MONTH} || '/' || {_YEAR}
    WHEN 6 THEN {_DAY} || '/' || {_MONTH} || '/' || substr(shipped, 2, 3)
    WHEN 7 THEN {_DAY} || '/' || {_MONTH} || '/' || {_YEAR} || '1'
    WHEN 8 THEN {_DAY} || ' ' || {_MONTH} || ' ' || substr(shipped, 3, 2)
    WHEN 9 THEN {_SHORT_DATE} || ' 12:30'
    ELSE {_SHORT_DATE} END AS day_text
FROM {_LINES}"""

FILE_NAMES = f"""
SELECT o_orderkey,
  CASE o_orderkey % 5
    WHEN 0 THEN CAST({_ORDER_YEAR} AS STRING) || '13_bill.csv'
    WHEN 1 THEN CAST({_ORDER_YEAR} AS STRING) || '00_bill.csv'
    ELSE {_FILE_MONTH} || '_bill.csv' END AS file_name
FROM {{orders}}"""

MONTH_TEXTS = f"""
SELECT o_orderkey,
  CASE WHEN o_orderkey % 9 = 0 THEN lower({_month_name(_ORDER_MONTH)})
       ELSE {_month_name(_ORDER_MONTH)} END AS month_text,
  CAST(o_orderkey % 15 - 1 AS INT) AS month_index
FROM {{orders}}"""

# The 17 columns of an itemized bill file and its name, one per order line.
ITEMIZED_TEXT = f"""
SELECT CASE l_orderkey % 97
    WHEN 0 THEN {_CUSTOMER}
    WHEN 1 THEN '(012)'
    ELSE '(0123)' || {_CUSTOMER} END
    AS `Calling Number`,
  CASE WHEN l_orderkey % 89 = 0 THEN short_date
       ELSE short_date || ' - 28' || substr(short_date, 3) END AS `Date`,
  CAST(l_linenumber AS STRING) || ':00' AS `Time`,
  l_returnflag AS `Type`,
  CAST(l_suppkey AS STRING) AS `From`,
  CAST(l_partkey AS STRING) AS `To`,
  l_linestatus AS `Operator`,
  {_CUSTOMER} AS `PhoneNumber`,
  CASE WHEN l_orderkey % 83 = 0 THEN 'withheld'
       ELSE '+60 ' || CAST(l_partkey AS STRING) END
    AS `NumberCalled`,
  CASE WHEN l_orderkey % 79 = 0 THEN 'n/a' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END
    AS `Quantity`,
  CAST(l_linenumber AS STRING) AS `Size`,
  l_returnflag AS `Duration`,
  CASE WHEN l_orderkey % 2 = 0 THEN 'off-peak' ELSE 'peak' END AS `Period`,
  {_money('l_extendedprice')} AS `GrossAmount`,
  {_money('l_discount')} AS `Discount`,
  {_money('l_tax')} AS `Total`,
  l_linestatus AS `Call Type`,
  CASE WHEN l_orderkey % 71 = 0 THEN substr(ordered, 1, 4) || '13_x.csv'
       ELSE {_ORDERED_MONTH} || '_x.csv' END AS file_name
FROM (SELECT *, {_SHORT_DATE} AS short_date FROM {_LINES}) texts
JOIN {_DATED_ORDERS} ON l_orderkey = o_orderkey"""

# Typed itemized bills, one per order line.
ITEMIZED = f"""
SELECT {_phone('o_custkey')} AS phone_number,
  '0' || CAST(10 + o_custkey % 10 AS STRING) AS STD_code,
  CAST(l_shipdate AS DATE) AS start_date,
  CAST(NULL AS DATE) AS end_date,
  {_two('l_suppkey % 24')} || ':' || {_two('l_partkey % 60')} AS time,
  l_returnflag AS call_type,
  'net' || CAST(l_suppkey % 7 AS STRING) AS calling_network,
  'net' || CAST(l_partkey % 5 AS STRING) AS called_network,
  'roam' || l_linestatus AS roaming_operator,
  {_CUSTOMER} AS incoming_number,
  l_partkey AS outgoing_number,
  CAST(l_quantity AS INT) AS quantity,
  CAST(l_linenumber AS STRING) || 'MB' AS size,
  '00:' || {_two('l_linenumber')} || ':00' AS duration,
  'peak' AS period,
  l_extendedprice AS gross_amount,
  l_discount AS discount,
  l_tax AS total,
  l_linestatus AS charges_type,
  {_month_name(_ORDER_MONTH)} AS billing_month,
  {_ORDER_YEAR} AS billing_year,
  CASE WHEN l_orderkey % 2 = 0 THEN 'MAXIS' ELSE 'CELCOM' END AS operator
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey"""

def _monthly(account: str) -> str:
    return f"""
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'MAXIS' ELSE 'CELCOM' END AS operator,
  {_phone('o_custkey')} AS phone_number,
  '0' || CAST(10 + o_custkey % 10 AS STRING) AS STD_code,
  CAST({account} AS BIGINT) AS account_number,
  CAST(NULL AS BIGINT) AS employee_account_number,
  CAST(NULL AS DOUBLE) AS credit_limit,
  CAST(o_orderkey % 300 AS DOUBLE) AS base_charges,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey % 20 AS DOUBLE) END
    AS value_added_service,
  CAST(o_custkey % 500 AS DOUBLE) AS usage_charges,
  CAST(0 AS DOUBLE) AS other_charges,
  CAST(o_orderkey % 5 AS DOUBLE) AS discount,
  o_totalprice AS total,
  {_month_name(_ORDER_MONTH)} AS billing_month,
  {_ORDER_YEAR} AS billing_year
FROM {{orders}}"""

# Typed monthly bills, each order billed twice: under two accounts, or as a plain copy.
MONTHLY = (
    _monthly("o_orderkey % 1000")
    + " UNION ALL "
    + _monthly("CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE 1000 END + o_orderkey % 1000")
)

# Cell texts of MAXIS bill lines: one workbook per month, one line per order. Some
# lines are captions (no third cell) or subtotals (text in the base column).
MAXIS_LINES = f"""
SELECT 'maxis/' || {_FILE_MONTH} || '.xlsx' AS path,
  CAST(6 + o_orderkey AS INT) AS row,
  CASE WHEN o_orderkey % 58 = 0 THEN {_CUSTOMER}
       ELSE '(0' || CAST(10 + o_custkey % 10 AS STRING) || ')' || {_CUSTOMER} END AS contact,
  CASE WHEN o_orderkey % 46 <> 0 THEN 'plan' END AS plan_name,
  CASE WHEN o_orderkey % 38 = 0 THEN 'Subtotal' ELSE {_money('o_totalprice')} END AS base,
  CAST(o_orderkey % 100 AS STRING) || '.50' AS value_added,
  CAST(o_custkey % 1000 AS STRING) || '.25' AS usage,
  '0' AS other,
  '-' || CAST(o_orderkey % 10 AS STRING) || '.75' AS discount,
  {_money('o_totalprice + 1')} AS total
FROM {{orders}}"""

# Statement cells of the MAXIS workbooks.
MAXIS_STATEMENTS = f"""
SELECT 'maxis/' || {_FILE_MONTH} || '.xlsx' AS path,
  '05/' || {_two(_ORDER_MONTH)} || '/' || CAST({_ORDER_YEAR} AS STRING) || ' - 28/'
    || {_two(_ORDER_MONTH)} || '/' || CAST({_ORDER_YEAR} AS STRING) AS period_text,
  'No ' || CAST(100000000 + {_ORDER_YEAR} * 100 + {_ORDER_MONTH} AS STRING) || ' / 1'
    AS account_text
FROM {{orders}}
GROUP BY {_ORDER_YEAR}, {_ORDER_MONTH}"""

# Cell texts of CELCOM bill lines: one workbook per month, one line per order. Some
# lines are footers without an account or a limit.
CELCOM_LINES = f"""
SELECT 'celcom/' || {_FILE_MONTH} || '.xlsx' AS path,
  CAST(15 + o_orderkey AS INT) AS row,
  {_ORDER_MONTH} AS month_number,
  CASE WHEN o_orderkey % 31 = 0 THEN {_CUSTOMER}
       ELSE '0' || CAST(10 + o_custkey % 10 AS STRING) || '-'
         || CAST({_phone('o_custkey')} AS STRING) END AS mobile,
  CASE WHEN o_orderkey % 29 <> 0 THEN CAST(7000 + o_orderkey % 1000 AS STRING) END
    AS account,
  CASE WHEN o_orderkey % 3 = 0 THEN 'none' ELSE CAST(o_custkey AS STRING) END AS child,
  CASE WHEN o_orderkey % 23 = 0 THEN '  ' ELSE CAST(o_custkey % 400 AS STRING) END
    AS credit_limit,
  {_money('o_totalprice')} AS base,
  CAST(o_custkey % 1000 AS STRING) || '.25' AS usage,
  CASE WHEN o_orderkey % 7 = 0 THEN '1,200.50' ELSE '3' END AS one_time,
  '-' || CAST(o_orderkey % 10 AS STRING) || '.75' AS discount,
  {_money('o_totalprice + 2')} AS total
FROM {{orders}}"""

CELCOM_STATEMENTS = f"""
SELECT 'celcom/' || {_FILE_MONTH} || '.xlsx' AS path,
  {_ORDER_MONTH} AS month_number,
  '07 ' || substr({_month_name(_ORDER_MONTH)}, 1, 3) || ' ' || CAST({_ORDER_YEAR} AS STRING)
    AS date_text
FROM {{orders}}
GROUP BY {_ORDER_YEAR}, {_ORDER_MONTH}"""

# Cell texts of the staff list: one workbook per region, one line per customer.
STAFF_LINES = f"""
SELECT 'staff/' || r_name || '.xlsx' AS path,
  CAST(4 + c_custkey AS INT) AS row,
  CASE c_custkey % 50
    WHEN 0 THEN 'NEW'
    WHEN 1 THEN 'null'
    WHEN 2 THEN NULL
    WHEN 3 THEN CAST(c_custkey AS STRING)
    ELSE lpad(CAST(c_nationkey AS STRING), 3, '0') || '-'
      || CAST({_phone('c_custkey')} AS STRING) END
    AS number,
  c_name AS username,
  n_name AS location,
  c_mktsegment AS cost_center,
  r_name AS department,
  CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'phone' || CAST(c_custkey % 12 AS STRING) END
    AS phone_model,
  'head of ' || n_name AS supervisor,
  'head of ' || r_name AS head_of_department,
  CASE WHEN c_custkey % 2 = 0 THEN 'MAXIS' ELSE 'CELCOM' END AS provider
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
JOIN {{region}} ON n_regionkey = r_regionkey"""

# Columns of a table to copy as its source describes them, one per part.
DESCRIBED = """
SELECT 'c' || CAST(p_partkey AS STRING) AS Field,
  CASE p_partkey % 16
    WHEN 0 THEN 'int(11)' WHEN 1 THEN 'tinyint(1)' WHEN 2 THEN 'smallint(6)'
    WHEN 3 THEN 'bigint(20)' WHEN 4 THEN 'bigint' WHEN 5 THEN 'char(3)'
    WHEN 6 THEN 'text' WHEN 7 THEN 'longtext' WHEN 8 THEN 'double' WHEN 9 THEN 'float'
    WHEN 10 THEN 'decimal(10,2)' WHEN 11 THEN 'datetime' WHEN 12 THEN 'date'
    WHEN 13 THEN 'int unsigned' WHEN 14 THEN 'json'
    ELSE 'varchar(' || CAST(p_size AS STRING) || ')' END AS Type,
  CASE WHEN p_partkey % 3 = 0 THEN 'NO' ELSE 'YES' END AS `Null`
FROM {part}"""

# Headerless activity columns, one slot per event: the event type says which of the five
# measures is known. ``{millis}`` stands for the engine's own epoch milliseconds of ts.
ACTIVITY = """
SELECT CASE WHEN event_id % 11 <> 0 THEN user_id END AS _c0,
  {millis} AS _c1,
  CASE WHEN event_id % 3 <> 0 THEN CAST(30 + event_id % 9 AS BIGINT) END AS _c2,
  CASE WHEN event_type = 'click' THEN value END AS _c3,
  CASE WHEN event_type = 'view' THEN value END AS _c4,
  CASE WHEN event_type = 'purchase' THEN value END AS _c5,
  CASE WHEN event_type = 'signup' THEN value END AS _c6,
  CASE WHEN event_type = 'error' THEN value END AS _c7
FROM {events}"""

SPARK_MILLIS = (
    "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) div 1000"
)
ORACLE_MILLIS = "epoch_us(ts) // 1000"


def oracle_text(text: str) -> str:
    """The input as a SQL oracle subquery over its own tables."""
    names = {name: name for name in TABLES}
    return text.format(millis=ORACLE_MILLIS, **names).replace("`", '"')
