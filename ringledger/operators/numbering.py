"""Row numbers, batch numbers and first-n over a total order, without a single-task sort."""

import sys
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    AtomicType,
    BooleanType,
    DataType,
    DateType,
    FractionalType,
    IntegralType,
    LongType,
    StringType,
    TimestampType,
)

from ringledger.operators.staging import staged


def number_rows(df: DataFrame, *order_by: str, name: str = "row_number") -> DataFrame:
    """Adds each row's 1-based position in the order of the given columns.

    Rows are range-partitioned and sorted where they lie, then written once with their
    position inside the partition. Partition sizes, one row per partition and read from
    that one column, give the offset to add. Together the columns should identify a
    row: a column with a hot value then spreads by the next one.
    """
    columns = df.columns
    placed = staged(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .select("*", F.monotonically_increasing_id().alias("_position")),
        "numbered",
    )
    # The generated id holds the partition above bit 33 and the position below it.
    partition = F.shiftright("_position", 33)
    sizes = placed.groupBy(partition.alias("_partition")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    inside = F.col("_position").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")  # one row per partition
        .select(*columns, (F.col("_offset") + inside + 1).alias(name))
    )


def number_batches(df: DataFrame, size: int, *order_by: str) -> DataFrame:
    """Adds the 1-based number of the fixed-size batch each row falls into, in order."""
    numbered = number_rows(df, *order_by, name="_row")
    batch = F.expr(f"(_row - 1) div {size} + 1").alias("batch_number")
    return numbered.select(*df.columns, batch)


# Rows among which one task looks for the n-th key.
RANKED_AT_ONCE = 100_000
# Ranks that a sketch may be off by, several of its standard errors.
RANK_ERROR = 0.03


def first_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """The ``n`` rows with the lowest key, NULL lowest, in no particular order; all for 0.

    The n-th key is found from the key column alone and then reaches the scan as a plain
    filter. Rows that share it are cut exactly, by the order of their other columns, which
    spreads them over tasks.
    """
    if n == 0:
        return df
    found = _nth_key(df.select(key), n, key)
    if found is None:
        return df
    cutoff, below, upto = found
    if cutoff is None:
        ties = df.where(F.col(key).isNull())
        return ties if upto == n else _cut(ties, n, key)
    if upto == n:
        return df.where(F.col(key).isNull() | (F.col(key) <= cutoff))
    lower = df.where(F.col(key).isNull() | (F.col(key) < cutoff))
    ties = df.where(F.col(key) == cutoff)
    return lower.unionByName(_cut(ties, n - below, key))


def _nth_key(keys: DataFrame, n: int, key: str) -> tuple[object, int, int] | None:
    """The n-th lowest key, the rows below it and the rows up to it; None for fewer rows.

    A quantile sketch, merged map-side, gives a lower and an upper bound of the key. Rows below
    the bounds are counted exactly, so a bound that misses shows, and the bounds are drawn in
    until little is between them. Only there are keys counted one by one.
    """
    kind = keys.schema[key].dataType
    place = _place(key, kind)
    bounds, error = (None, None), RANK_ERROR
    now = _measured(keys, place, bounds)
    if now.upto < n:
        return None
    if n <= now.under:
        return None, 0, now.under
    while (size := now.upto - now.under) > RANKED_AT_ONCE and error < 1:
        ends = now.ends(keys.sparkSession, n, error)
        if _apart(kind) and 2 * error * size <= RANKED_AT_ONCE:
            if row := _ranked(_counted(keys, place, key, ends), n, key):
                return row[key], row["_reached"] - row["_rows"], row["_reached"]
        else:
            then = _measured(keys, place, ends)
            if then.under < n <= then.upto:
                now, bounds = then, ends
                if 2 * (now.upto - now.under) > size:
                    break  # one key, or keys with one place, hold most of it
                continue
        error *= 2
    counted = _counted(keys, place, key, bounds)
    few = now.upto - now.under <= RANKED_AT_ONCE
    row = (_ranked if few else _ranked_by_range)(counted, n, key)
    return row[key], row["_reached"] - row["_rows"], row["_reached"]


def _place(key: str, kind: DataType) -> Column:
    """A number that never falls where the key rises, and that is NULL for a NULL key.

    Whole numbers and floats stand for themselves, so bounds of them reach the scan.
    """
    value = F.col(key)
    if isinstance(kind, IntegralType):
        return value.cast("long")
    if isinstance(kind, FractionalType):
        # NaN is the highest key, and sketches leave it out.
        number = value.cast("double")
        return F.when(F.isnan(number), sys.float_info.max).otherwise(number)
    if isinstance(kind, (DateType, BooleanType)):
        return (F.unix_date(value) if isinstance(kind, DateType) else value.cast("int")).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, StringType):
        head = F.hex(F.substring(F.encode(value, "UTF-8"), 1, 6))
        return F.conv(F.rpad(head, 12, "0"), 16, 10).cast("double")
    return F.when(value.isNotNull(), 0.0)


def _apart(kind: DataType) -> bool:
    """Whether hardly any two keys share a place."""
    return isinstance(kind, (IntegralType, FractionalType, DateType, BooleanType, TimestampType))


def _inside(keys: DataFrame, place: Column, bounds: tuple) -> tuple[DataFrame, Column]:
    """Rows up to the higher bound, and which of them lie below the lower: without it, NULL keys."""
    low, high = bounds
    inside = keys if high is None else keys.where(place.isNull() | (place <= high))
    return inside, place.isNull() if low is None else place.isNull() | (place < low)


@dataclass(frozen=True)
class _Measure:
    """Rows below some bounds and up to the higher one, and a sketch of the places between."""

    under: int
    upto: int
    sketch: bytes
    whole: bool

    def ends(self, spark: SparkSession, n: int, error: float) -> tuple:
        """Closer bounds of the n-th row's place."""
        goal = (n - self.under) / (self.upto - self.under)
        ranks = F.array(F.lit(max(0.0, goal - error)), F.lit(min(1.0, goal + error)))
        quantiles = F.kll_sketch_get_quantile_bigint if self.whole else F.kll_sketch_get_quantile_double
        return tuple(spark.sql("SELECT 1").select(quantiles(F.lit(self.sketch), ranks)).first()[0])


def _measured(keys: DataFrame, place: Column, bounds: tuple) -> _Measure:
    inside, before = _inside(keys, place, bounds)
    whole = isinstance(keys.select(place).schema[0].dataType, LongType)
    sketch = F.kll_sketch_agg_bigint if whole else F.kll_sketch_agg_double
    told = inside.agg(F.count_if(before), F.count("*"), sketch(F.when(~before, place))).first()
    return _Measure(*told, whole)


def _counted(keys: DataFrame, place: Column, key: str, bounds: tuple) -> DataFrame:
    """Rows of each key between the bounds, and of all below them as one row (``_before``)."""
    inside, before = _inside(keys, place, bounds)
    return inside.groupBy(before.alias("_before"), F.when(~before, F.col(key)).alias(key)).agg(
        F.count("*").alias("_rows")
    )


def _ranked(counted: DataFrame, n: int, key: str) -> Row | None:
    """The key of the n-th row among few keys, with its rows and those up to it; None if that
    row is not among the keys counted."""
    order = Window.orderBy(F.desc("_before"), F.col(key).asc_nulls_first())
    upto = counted.withColumn(
        "_reached", F.sum("_rows").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    row = upto.where(F.col("_reached") >= n).agg(
        F.min_by(F.struct(key, "_before", "_rows", "_reached"), "_reached").alias("row")
    ).first()["row"]
    return None if row is None or row["_before"] else row


def _ranked_by_range(counted: DataFrame, n: int, key: str) -> Row:
    """The same among many keys, as a place shared by them or a wide bracket leaves.

    Distinct keys are dealt out by range; the ranges' sums tell which one holds the n-th row,
    and only that one is looked into.
    """
    order = [F.desc("_before"), F.col(key).asc_nulls_first()]
    placed = staged(
        counted.repartitionByRange(*order).withColumn("_partition", F.spark_partition_id()), "keys"
    )
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, 0)
    sums = placed.groupBy("_partition").agg(F.sum("_rows").alias("_rows"))
    reached = sums.select("_partition", "_rows", F.sum("_rows").over(before).alias("_reached"))
    part = reached.where(F.col("_reached") >= n).orderBy("_partition").first()
    start = part["_reached"] - part["_rows"]
    row = _ranked(placed.where(F.col("_partition") == part["_partition"]), n - start, key)
    return Row(**row.asDict() | {"_reached": row["_reached"] + start})


def _cut(ties: DataFrame, n: int, key: str) -> DataFrame:
    rest = [f.name for f in ties.schema if f.name != key and _ordered(f.dataType)]
    numbered = number_rows(ties, *(rest or [key]), name="_row")
    return numbered.where(F.col("_row") <= n).drop("_row")


def _ordered(kind: DataType) -> bool:
    return isinstance(kind, AtomicType)
