"""Fingerprints as points of a grid of segment counts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The lower bit of every two-bit segment.
LOW_BITS = 0x5555555555555555


def unary_counts(fp: Column) -> Column:
    """Every two-bit segment's count in unary: 00, 01 or 11."""
    low, high = fp.bitwiseAND(LOW_BITS), F.shiftrightunsigned(fp, 1).bitwiseAND(LOW_BITS)
    return F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseOR(high))
