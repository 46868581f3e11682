"""Hourly activity over a stream in which every row is accounted for.

A batch adds partial sums and counts per hour to a folder of its own, so there is no state store
and nothing stored is written again; ``counted_hours`` adds them up. Rows of hours that were closed
when their batch came land among the rejected rows with the reason, and so do slots that were
delivered before. Each batch notes how many rows it read: they are those it counted and rejected.

An hour is closed once it ended ``late_by`` or more before the newest time of earlier batches. That
time stands in the stored hours, so a repeated batch closes the same hours, and its folders replace
what a stopped run left. The note of a batch is written last.
"""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType, StructField, StructType

from ringledger.operators.staging import delete_folder, folder_exists, folders
from ringledger.plans.activity import HOUR
from ringledger.schemas import ACTIVITY_MEASURES
from ringledger.streaming.activity import BATCH

# What names a slot; a second row with the same values is a repeated delivery.
SLOT = ("square_id", "beginning_time", "country_code")
REASON = "reason"
NO_TIME, LATE, REPEATED = "no time", "hour is closed", "slot delivered before"

NOTE = StructType([StructField(name, LongType()) for name in ("n_read", "n_counted", "n_rejected")])


def write_slots(
    activity: DataFrame, path: str, checkpoint: str, late_by: str = "2 hours", once: bool = False
) -> DataStreamWriter:
    """Writer that counts the rows of a cleaned activity stream under ``path``.

    ``once`` counts a slot delivered twice one time only; it keeps the names of the slots of open
    hours. Of copies within a batch that differ, any one is counted, always the same.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, here = batch.sparkSession, f"{BATCH}={batch_id}"
        bound = _closed_before(spark, path, batch_id, late_by)
        # Both outputs read the batch; what is lost with an executor is read again.
        told = batch.withColumn(REASON, _reason(bound)).persist()
        try:
            n_read = told.count()
            marked = _once(told, _slots_before(spark, path, batch_id, bound)) if once else told
            fresh = marked.where(F.col(REASON).isNull())
            partial = _partial(fresh)
            partial.write.mode("overwrite").parquet(f"{path}/hours/{here}")
            if once:
                names = fresh.select(*SLOT, _hour_end().alias("end"))
                names.write.mode("overwrite").parquet(f"{path}/slots/{here}")
            rejected = marked.where(F.col(REASON).isNotNull())
            rejected.write.mode("overwrite").parquet(f"{path}/rejected/{here}")
        finally:
            told.unpersist()
        counted = spark.read.schema(partial.schema).parquet(f"{path}/hours/{here}")
        refused = spark.read.schema(rejected.schema).parquet(f"{path}/rejected/{here}")
        n_counted = counted.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
        note = spark.createDataFrame([(n_read, n_counted, refused.count())], NOTE).coalesce(1)
        note.write.mode("overwrite").parquet(f"{path}/notes/{here}")
        if once:
            _forget(spark, path, batch_id, bound)

    return activity.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def _hour_end() -> Column:
    return F.window("beginning_time", HOUR)["end"]


def _partial(rows: DataFrame) -> DataFrame:
    """Sum and count of the measures, rows and newest time of every hour: a row per hour and task
    is all that is shuffled."""
    total = reduce(add, [F.col(name) for name in ACTIVITY_MEASURES])
    return rows.groupBy(F.window("beginning_time", HOUR)).agg(
        F.sum(total).alias("total"), F.count(total).alias("n"), F.count(F.lit(1)).alias("n_rows"),
        F.max("beginning_time").alias("newest"),
    ).select("window.start", "window.end", "total", "n", "n_rows", "newest")


def _batches(spark: SparkSession, path: str, before: int | None = None) -> list[int]:
    if not folder_exists(spark, path):
        return []
    numbers = (int(name.partition("=")[2]) for name in folders(spark, path))
    return sorted(k for k in numbers if before is None or k < before)


def _closed_before(spark: SparkSession, path: str, batch_id: int, late_by: str) -> Column:
    """The time up to which hours are closed; NULL in the first batch.

    The newest time is one value of small files, a row per hour and batch."""
    if not _batches(spark, f"{path}/hours", batch_id):
        return F.lit(None).cast("timestamp")
    stored = spark.read.parquet(f"{path}/hours").where(F.col(BATCH) < batch_id)
    bound = stored.agg((F.max("newest") - F.expr(f"INTERVAL {late_by}")).alias("bound"))
    return F.lit(bound.first()[0]).cast("timestamp")


def _reason(bound: Column) -> Column:
    return F.when(F.col("beginning_time").isNull(), NO_TIME).when(_hour_end() <= bound, LATE)


def _slots_before(spark: SparkSession, path: str, batch_id: int, bound: Column) -> DataFrame | None:
    """Slots of open hours that earlier batches counted."""
    if not _batches(spark, f"{path}/slots", batch_id):
        return None
    stored = spark.read.parquet(f"{path}/slots").where(F.col(BATCH) < batch_id)
    return stored.where(F.coalesce(F.col("end") > bound, F.lit(True))).select(*SLOT)


def _once(told: DataFrame, known: DataFrame | None) -> DataFrame:
    """Marks the repeats among the rows without a reason, beside equal slots and known ones.

    One shuffle by slot serves both; a slot delivered very often is one sorted group that spills.
    """
    columns = told.columns
    found = told.where(F.col(REASON).isNull()).withColumn("known_slot", F.lit(False))
    if known is not None:
        nothing = [F.lit(None).cast(told.schema[name].dataType).alias(name) for name in columns if name not in SLOT]
        found = found.unionByName(known.select(*SLOT, *nothing, F.lit(True).alias("known_slot")))
    values = [name for name in columns if name != REASON]
    ordered = Window.partitionBy(*SLOT).orderBy(F.col("known_slot").desc(), F.xxhash64(*values))
    ranked = found.withColumn("nth_slot", F.row_number().over(ordered)).where("not known_slot")
    marked = ranked.withColumn(REASON, F.when(F.col("nth_slot") > 1, F.lit(REPEATED)))
    return told.where(F.col(REASON).isNotNull()).unionByName(marked.select(*columns))


def _forget(spark: SparkSession, path: str, batch_id: int, bound: Column) -> None:
    """Deletes the slot names of batches all of whose hours are closed; no later batch reads them."""
    if not _batches(spark, f"{path}/slots", batch_id):
        return
    stored = spark.read.parquet(f"{path}/slots").where(F.col(BATCH) < batch_id)
    closed = stored.groupBy(BATCH).agg(F.max("end").alias("end")).where(F.col("end") <= bound)
    for row in closed.select(BATCH).collect():  # a row per batch that is still kept
        delete_folder(spark, f"{path}/slots/{BATCH}={row[0]}")


def counted_hours(spark: SparkSession, path: str) -> DataFrame:
    """``start, end, hourly_average, n_rows`` of every hour."""
    stored = spark.read.parquet(f"{path}/hours")
    summed = stored.groupBy("start", "end").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"), F.sum("n_rows").alias("n_rows")
    )
    average = (F.col("total").cast("double") / F.col("n")).alias("hourly_average")
    return summed.select("start", "end", average, "n_rows")


def rejected_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that were not counted, with ``reason`` and batch."""
    return spark.read.parquet(f"{path}/rejected")


def batch_notes(spark: SparkSession, path: str) -> DataFrame:
    """``n_read, n_counted, n_rejected`` of every batch; the first is the sum of the others."""
    return spark.read.parquet(f"{path}/notes")
