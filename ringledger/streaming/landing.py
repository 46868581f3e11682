"""Feed folders ingested file by file, each file once, into partitioned ORC tables.

A file source lists the folder and its checkpoint remembers the files taken. Each micro-batch
writes its own ``ingest_batch`` partitions, replacing them: after a crash Spark repeats the batch
with the same files, and the table still holds every row once.

A file that can't be read, or lacks a needed sheet or header, does not hold up the others: it
lands nothing and is noted in ``refused_files`` with the reason. ``retry_refused`` takes it again
once its modification time changes, in a batch numbered from ``RETRIES`` on.

``archive_taken`` moves files away. It goes by what the checkpoint says: files of committed
batches, still as they were when taken. So it may run at any time and any number of times.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ringledger.operators.staging import delete_folder, folder_exists, listed, move_file, staged
from ringledger.plans.feeds import (
    CELCOM_BILL_RANGE,
    CELCOM_SHEETS,
    EMPLOYEE_RANGE,
    EMPLOYEE_SHEETS,
    MAXIS_SHEETS,
    MAXIS_SUMMARY_RANGE,
    employee_rows,
    normalise_celcom_monthly,
    normalise_employees,
    normalise_itemized,
    normalise_maxis_monthly,
)
from ringledger.schemas import (
    BINARY_FILES,
    CELCOM_HEADERS,
    CELCOM_MONTHLY_FOLDER,
    EMPLOYEE_FOLDER,
    EMPLOYEE_HEADERS,
    EMPLOYEE_MASTER,
    ITEMIZED_BILL,
    ITEMIZED_CSV,
    ITEMIZED_FOLDER,
    MAXIS_MONTHLY_FOLDER,
    MONTHLY_BILL_SUMMARY,
)
from ringledger.sinks.tables import ensure_table, rebalanced, replace_partitions
from ringledger.sources.files import by_own_header, csv_lines, headless
from ringledger.sources.sheets import lacking
from ringledger.sources.workbook import workbook_rows

FEED = "feed"
BATCH = "ingest_batch"
PERIOD = ["billing_year", "billing_month"]
# The first batch number of files that were refused before.
RETRIES = 1_000_000_000_000
REFUSED = StructType([
    StructField("path", StringType()),
    StructField("modified", TimestampType()),
    StructField("reason", StringType()),
    StructField(FEED, StringType()),
    StructField(BATCH, LongType()),
])


@dataclass(frozen=True)
class Feed:
    """A landing folder, the table it fills and how its files become rows."""

    name: str
    folder: str
    table: str
    schema: StructType
    periods: list[str]
    normalise: Callable[[DataFrame], DataFrame]
    # Of a feed of workbooks: the sheets to unpack, and ranges each must have, with the headers
    # it must name.
    sheets: dict[str | None, int] | None = None
    needed: tuple[tuple, ...] = ()


FEEDS = [
    Feed(
        "employees", EMPLOYEE_FOLDER, "employee_master", EMPLOYEE_MASTER, [],
        lambda rows: normalise_employees(employee_rows(rows)), EMPLOYEE_SHEETS,
        ((*EMPLOYEE_RANGE, EMPLOYEE_HEADERS),),
    ),
    Feed(
        "itemized", ITEMIZED_FOLDER, "itemized_bill", ITEMIZED_BILL, PERIOD,
        normalise_itemized,
    ),
    Feed(
        "maxis_monthly", MAXIS_MONTHLY_FOLDER, "monthly_bill_summary",
        MONTHLY_BILL_SUMMARY, PERIOD, normalise_maxis_monthly, MAXIS_SHEETS,
        (MAXIS_SUMMARY_RANGE,),
    ),
    Feed(
        "celcom_monthly", CELCOM_MONTHLY_FOLDER, "monthly_bill_summary",
        MONTHLY_BILL_SUMMARY, PERIOD, normalise_celcom_monthly, CELCOM_SHEETS,
        ((*CELCOM_BILL_RANGE, CELCOM_HEADERS),),
    ),
]


def _folder(feed: Feed, source: str) -> str:
    return f"{source.rstrip('/')}/{feed.folder}"


def _files(reader: DataFrameReader | DataStreamReader, feed: Feed, path: str | list[str]) -> DataFrame:
    # A file may be taken away before its batch is run again.
    reader = reader.option("ignoreMissingFiles", True)
    if feed.sheets is None:
        return csv_lines(reader.format("text").load(path))
    return reader.format("binaryFile").schema(BINARY_FILES).load(path)


def landed_table(spark: SparkSession, database: str, feed: Feed) -> str:
    """Name of the feed's table, created when absent."""
    table = f"{database}.{feed.table}"
    schema = StructType([
        *feed.schema, StructField(FEED, StringType()), StructField(BATCH, LongType())
    ])
    ensure_table(spark, table, schema, [*feed.periods, FEED, BATCH])
    return table


def refused_table(spark: SparkSession, database: str) -> str:
    """Name of the log of refused files, created when absent.

    A row per file and batch that took it: ``reason`` tells why it was refused and is NULL where
    a later batch landed it.
    """
    table = f"{database}.refused_files"
    ensure_table(spark, table, REFUSED, [FEED, BATCH])
    return table


def _refused(feed: Feed, files: DataFrame, rows: DataFrame) -> DataFrame:
    """``path, modified, reason`` of the workbooks that would land nothing."""
    bad = files.select("path").join(rows.select("path").distinct(), "path", "left_anti")
    bad = bad.withColumn("reason", F.lit("no workbook, or none of the sheets"))
    for part in feed.needed:
        lacks = lacking(rows, *part).withColumn("reason", F.lit(f"no sheet or header as in {part[:4]}"))
        bad = bad.unionByName(lacks)
    told = bad.groupBy("path").agg(F.min("reason").alias("reason"))
    return files.select("path", F.col("modificationTime").alias("modified")).join(told, "path")


def _land(spark: SparkSession, feed: Feed, database: str, state: str, batch: DataFrame,
          batch_id: int, again: DataFrame | None = None) -> None:
    """Lands the good files of a batch and notes the others; ``again`` (``path, modified``) are
    files that were refused before."""
    unpacked = f"{state}-rows/{batch_id}"
    if feed.sheets is None:
        bad = headless(batch, ITEMIZED_CSV.names).withColumn("reason", F.lit("no header line"))
        bad = staged(bad.select("path", "modified", "reason"), "refused")
        rows = by_own_header(batch, ITEMIZED_CSV.names, skip_headless=True)
    else:
        every = staged(workbook_rows(batch, feed.sheets, skip_broken=True), feed.name, unpacked)
        bad = staged(_refused(feed, batch, every), "refused")
        rows = every.join(bad, "path", "left_anti")
    marks = {FEED: F.lit(feed.name), BATCH: F.lit(batch_id).cast("long")}
    marked = feed.normalise(rows).withColumns(marks)
    replace_partitions(
        rebalanced(marked, feed.periods) if feed.periods else marked, landed_table(spark, database, feed)
    )
    noted = bad
    if again is not None:
        good = again.join(bad, "path", "left_anti").withColumn("reason", F.lit(None).cast("string"))
        noted = noted.unionByName(good)
    log = refused_table(spark, database)
    # A repeated batch may refuse less than it did.
    spark.sql(f"ALTER TABLE {log} DROP IF EXISTS PARTITION ({FEED}='{feed.name}', {BATCH}={batch_id})")
    if not noted.isEmpty():
        replace_partitions(noted.withColumns(marks), log)
    if feed.sheets is not None:
        delete_folder(spark, unpacked)


def ingest(
    spark: SparkSession, feed: Feed, source: str, database: str, checkpoints: str
) -> StreamingQuery:
    """Starts taking the files now waiting in the feed's folder; stops by itself."""
    landed_table(spark, database, feed)
    state = _state(feed, checkpoints)
    return (
        _files(spark.readStream, feed, _folder(feed, source))
        .writeStream.option("checkpointLocation", state)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, k: _land(spark, feed, database, state, batch, k))
        .start()
    )


def _state(feed: Feed, checkpoints: str) -> str:
    return f"{checkpoints.rstrip('/')}/{feed.name}"


def still_refused(spark: SparkSession, feed: Feed, database: str) -> DataFrame:
    """``path, modified`` of the feed's files whose last word is a refusal."""
    log = spark.table(refused_table(spark, database)).where(F.col(FEED) == feed.name)
    last = log.groupBy("path").agg(F.max_by(F.struct("modified", "reason"), BATCH).alias("last"))
    return last.where("last.reason is not null").select("path", "last.modified")


def retry_refused(
    spark: SparkSession, feed: Feed, source: str, database: str, checkpoints: str
) -> None:
    """Takes refused files that have changed since, as a batch of their own.

    The log tells the number of that batch, and is written last: a retry that failed is repeated
    under the same number and replaces what it had landed.
    """
    waiting = staged(still_refused(spark, feed, database), "refused")
    # A row per refused file.
    paths = [r["path"] for r in waiting.collect() if folder_exists(spark, r["path"])]
    if not paths:
        return
    files = _files(spark.read, feed, paths)
    time = "modified" if feed.sheets is None else "modificationTime"
    now = staged(files.select("path", F.col(time).alias("modified")).distinct(), "refused")
    changed = now.join(waiting, ["path", "modified"], "left_anti")
    if changed.isEmpty():
        return
    log = spark.table(refused_table(spark, database)).where(F.col(FEED) == feed.name)
    last = log.agg(F.max(F.when(F.col(BATCH) >= RETRIES, F.col(BATCH)))).first()[0]
    batch_id = RETRIES if last is None else last + 1
    batch = files.join(changed.select("path"), "path", "left_semi")
    _land(spark, feed, database, _state(feed, checkpoints), batch, batch_id, changed)


def archive_taken(
    spark: SparkSession, feed: Feed, source: str, database: str, checkpoints: str, archive: str
) -> int:
    """Moves the files of committed batches to the archive; returns how many.

    Refused files stay, and so does a file that has changed since it was taken. A file whose name
    the archive holds already gets its modification time behind it.
    """
    state = _state(feed, checkpoints)
    commits = [int(f.name) for f in listed(spark, f"{state}/commits") if f.name.isdigit()]
    present = listed(spark, _folder(feed, source))
    if not commits or not present:
        return 0
    taken = spark.read.text(f"{state}/sources/0").where(F.col("value").startswith("{")).select(
        F.from_json("value", "path string, timestamp long, batchId long").alias("x")
    ).where(F.col("x.batchId") <= max(commits))
    taken = taken.select(
        F.url_decode(F.replace(F.regexp_extract("x.path", "([^/]*)$", 1), F.lit("+"), F.lit("%2B")))
        .alias("name"), F.col("x.timestamp").alias("timestamp"),
    )
    there = spark.createDataFrame([(f.name, f.modified) for f in present], "name string, timestamp long")
    refused = still_refused(spark, feed, database).select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"))
    found = there.join(taken, ["name", "timestamp"], "left_semi").join(refused, "name", "left_anti")
    moved = {r["name"]: r["timestamp"] for r in found.collect()}  # what one folder holds
    target = f"{archive.rstrip('/')}/{feed.folder}"
    for name, time in moved.items():
        move_file(spark, f"{_folder(feed, source)}/{name}", target, f"{name}.{time}")
    return len(moved)


def land_waiting(
    spark: SparkSession,
    feed: Feed,
    source: str,
    database: str,
    checkpoints: str,
    archive: str | None = None,
) -> None:
    """Takes mended files, then what waits in the folder, and archives what was taken."""
    retry_refused(spark, feed, source, database, checkpoints)
    ingest(spark, feed, source, database, checkpoints).awaitTermination()
    if archive is not None:
        archive_taken(spark, feed, source, database, checkpoints, archive)
