"""Per-employee bill marts.

Staff meet bills on the phone number. Spark broadcasts the staff list while its size is
below ``spark.sql.autoBroadcastJoinThreshold`` (checked from statistics, and again at run
time); a larger one is shuffled, and a number that holds most of the bills is split by
the adaptive skew join, since nothing after the join needs its partitioning.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.schemas import EMPLOYEE_ITEMIZED_BILL, EMPLOYEE_MONTHLY_TOP


def _staff_with_bills(staff: DataFrame, bills: DataFrame, match_std: bool) -> DataFrame:
    staff = staff.select(*[F.col(name).alias(_staff(name)) for name in staff.columns])
    same: Column = F.col(_staff("contact_number")) == F.col("phone_number")
    if match_std:
        same = same & (F.col(_staff("STD_code")) == F.col("STD_code"))
    return bills.join(staff, same)


def _staff(name: str) -> str:
    return f"staff_{name}"


def _laid_out(joined: DataFrame, names: list[str], from_staff: list[str]) -> DataFrame:
    return joined.select(*[
        F.col(_staff(name)).alias(name) if name in from_staff else F.col(name)
        for name in names
    ])


STAFF_COLUMNS = [
    "username", "location", "cost_center", "department", "supervisor",
    "head_of_department", "type",
]


def employee_itemized_bill(
    staff: DataFrame, itemized: DataFrame, match_std: bool = False
) -> DataFrame:
    """Itemized bills of employees, one row per bill row and matching staff row.

    ``match_std`` also asks for the same dialling code, as one number may exist under two.
    """
    joined = _staff_with_bills(staff, itemized, match_std)
    return _laid_out(joined, EMPLOYEE_ITEMIZED_BILL.names, STAFF_COLUMNS)


def employee_monthly_top(
    staff: DataFrame, monthly: DataFrame, match_std: bool = False
) -> DataFrame:
    """Monthly bills of employees, from the distinct pairs of whole staff and bill rows.

    Distinct pairs are the pairs of distinct rows, so both sides drop their copies before
    they meet. Copies collapse map-side, the shuffle spreads by whole rows rather than by
    number, and the join stays last. Rows that differ only in columns left out here stay.
    """
    joined = _staff_with_bills(staff.distinct(), monthly.distinct(), match_std)
    return _laid_out(joined, EMPLOYEE_MONTHLY_TOP.names, STAFF_COLUMNS)


def monthly_union(*feeds: DataFrame) -> DataFrame:
    """Monthly bills of several operators as one table, columns matched by name."""
    union = feeds[0]
    for feed in feeds[1:]:
        union = union.unionByName(feed)
    return union
