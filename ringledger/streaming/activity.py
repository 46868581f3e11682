"""Hourly activity over a stream, with late rows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ringledger.operators.staging import delete_folder, folders, staged
from ringledger.plans.activity import hourly_average

BATCH = "ingest_batch"


def stream_hourly_average(activity: DataFrame, late_by: str = "2 hours") -> DataFrame:
    """Streaming hourly averages.

    Rows may come ``late_by`` after newer ones; in append and update mode hours older than
    that leave the state, so it holds the open hours only.
    """
    return hourly_average(activity.withWatermark("beginning_time", late_by))


def write_hours(hours: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Writer that keeps every hour under ``path``.

    A batch holds the hours it changed and is written once, to a folder of its own; nothing
    stored is read or written again. A repeated batch replaces its folder, and closed hours leave
    the state. ``read_hours`` gives the last word on each hour.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return (
        hours.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """The hours that ``write_hours`` keeps, each as the last batch that changed it left it."""
    stored = spark.read.parquet(path)
    told = [name for name in stored.columns if name not in ("start", BATCH)]
    last = stored.groupBy("start").agg(F.max_by(F.struct(*told), BATCH).alias("last"))
    return last.select("start", *[f"last.{name}" for name in told])


def compact_hours(spark: SparkSession, path: str) -> None:
    """Gathers all hours in the folder of the last batch; call it while the stream rests.

    Hours that the last batch left alone are added to its folder, then the older folders go. A
    run that stops in between leaves older words behind, which no reader hears; a finished batch
    is not repeated, so its folder stays as it is.
    """
    batches = sorted(int(name.partition("=")[2]) for name in folders(spark, path))
    if len(batches) < 2:
        return
    here = f"{path}/{BATCH}={batches[-1]}"
    kept = read_hours(spark, path).join(spark.read.parquet(here).select("start"), "start", "left_anti")
    staged(kept, "hours").coalesce(1).write.mode("append").parquet(here)
    for batch in batches[:-1]:
        delete_folder(spark, f"{path}/{BATCH}={batch}")
