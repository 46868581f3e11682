"""Few large partitions in place of the many small ones that landing leaves.

A landed table has a partition per period, feed and batch. Batches that all marts have taken in
are closed: nothing replaces them any more. ``compact`` packs the small partitions of closed
batches into bins and writes each bin as one partition, under a batch number below zero.

The swap is one commit: a row per replaced partition, written as one file to ``compactions``.
Before it, the new partitions do not count, after it the old ones do not, and ``landed_rows``
reads accordingly; whoever reads the bare table in between sees rows twice. Marts are told of the
new numbers beforehand, so they never take them for fresh bills. Old partitions go last. A run
that stops anywhere is made up for by the next one.
"""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ringledger.operators.staging import file_sizes, staged
from ringledger.sinks.tables import append_table, rebalanced, replace_partitions

FEED = "feed"
BATCH = "ingest_batch"
# Partitions at least half as large stay as they are.
TARGET_BYTES = 256 << 20

# How a partition list writes a NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

SWAPS = StructType([
    StructField("table", StringType()),
    StructField("old", StringType()),
    StructField(FEED, StringType()),
    StructField("into", LongType()),
])


@dataclass(frozen=True)
class Partition:
    """A partition by its folder, as ``column=value/...``."""

    folder: str

    @property
    def values(self) -> dict[str, str | None]:
        pairs = (part.split("=", 1) for part in self.folder.split("/"))
        return {name: None if value == NO_VALUE else value for name, value in pairs}

    @property
    def batch(self) -> int:
        return int(self.values[BATCH])

    @property
    def place(self) -> str:
        """What it shares with the partitions it may be merged with."""
        return self.folder.rsplit("/", 1)[0]

    def condition(self) -> Column:
        every = F.lit(True)
        for name, value in self.values.items():
            every = every & (F.col(name).isNull() if value is None else F.col(name) == value)
        return every

    def spec(self) -> str:
        return ", ".join(
            f"{name}=null" if value is None else f"{name}='{value}'" for name, value in self.values.items()
        )


def bins(sizes: dict[Partition, int], target: int) -> list[list[Partition]]:
    """Partitions of one place packed together: the largest first, each into the first bin that
    holds it. Those of half the target or more, and bins of one, are left out."""
    places: dict[str, list[tuple[int, list[Partition]]]] = {}
    for part, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0].folder)):
        if 2 * size >= target:
            continue
        held = places.setdefault(part.place, [])
        for k, (full, parts) in enumerate(held):
            if full + size <= target:
                held[k] = (full + size, [*parts, part])
                break
        else:
            held.append((size, [part]))
    return [parts for held in places.values() for _, parts in held if len(parts) > 1]


def _partitions(spark: SparkSession, table: str) -> list[Partition]:
    return [Partition(r[0]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def _swaps(spark: SparkSession, database: str, table: str) -> DataFrame:
    name = f"{database}.compactions"
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([], SWAPS)
    return spark.table(name).where(F.col("table") == table)


def _hidden(spark: SparkSession, database: str, table: str) -> list[Partition]:
    """Partitions that do not count: replaced ones, and new ones without a commit."""
    present = _partitions(spark, table)
    there = spark.createDataFrame([(p.folder, p.values[FEED], p.batch) for p in present] or [],
                                  f"old string, {FEED} string, batch long")
    swaps = staged(_swaps(spark, database, table), "swaps")
    replaced = there.join(swaps, ["old"], "left_semi")
    known = swaps.select(FEED, F.col("into").alias("batch"))
    stray = there.where("batch < 0").join(known, [FEED, "batch"], "left_anti")
    hidden = replaced.select("old").union(stray.select("old")).distinct()
    return [Partition(r["old"]) for r in hidden.collect()]


def landed_rows(spark: SparkSession, database: str, table: str) -> DataFrame:
    """The rows of a landed table, each once, whatever a compaction has got to.

    Between compactions no partition is hidden, and this is the bare table.
    """
    rows = spark.table(table)
    for part in _hidden(spark, database, table):
        rows = rows.where(~F.coalesce(part.condition(), F.lit(False)))
    return rows


def compact(spark: SparkSession, database: str, table: str, marts: Iterable[str],
            target: int = TARGET_BYTES) -> int:
    """Merges the small closed partitions of a landed table; returns how many went.

    Closed are batches that ``mart_progress`` names for all of ``marts``.
    """
    _drop(spark, table, _hidden(spark, database, table))
    marts = list(marts)
    closed = _closed(spark, database, marts)
    sizes = file_sizes(spark, _location(spark, table))
    small = {p: sizes.get(p.folder, 0) for p in _partitions(spark, table)
             if (p.values[FEED], p.batch) in closed}
    packed = bins(small, target)
    if not packed:
        return 0
    lowest = min((batch for _, batch in closed), default=0)
    into = {part: min(lowest, 0) - 1 - k for k, parts in enumerate(packed) for part in parts}
    _note(spark, database, marts, into)
    _merge(spark, table, into)
    swaps = [(table, part.folder, part.values[FEED], batch) for part, batch in into.items()]
    append_table(spark.createDataFrame(swaps, SWAPS).coalesce(1), f"{database}.compactions")
    _drop(spark, table, list(into))
    return len(into)


def _closed(spark: SparkSession, database: str, marts: list[str]) -> set[tuple[str, int]]:
    """Feed and batch of what all marts have taken in, a row per batch."""
    name = f"{database}.mart_progress"
    if not spark.catalog.tableExists(name):
        return set()
    taken = spark.table(name).where(F.col("mart").isin(marts)).groupBy(FEED, BATCH).agg(
        F.count_distinct("mart").alias("n")
    )
    return {(r[FEED], r[BATCH]) for r in taken.where(F.col("n") == len(marts)).collect()}


def _note(spark: SparkSession, database: str, marts: list[str], into: dict[Partition, int]) -> None:
    rows = {(mart, part.values[FEED], batch) for mart in marts for part, batch in into.items()}
    progress = spark.createDataFrame(sorted(rows), f"mart string, {FEED} string, {BATCH} long")
    append_table(progress, f"{database}.mart_progress")


def _merge(spark: SparkSession, table: str, into: dict[Partition, int]) -> None:
    number, wanted = F.lit(None).cast("long"), F.lit(False)
    by_batch: dict[int, list[Partition]] = {}
    for part, batch in into.items():
        by_batch.setdefault(batch, []).append(part)
    for batch, parts in by_batch.items():
        place = Partition(f"{parts[0].place}").condition()
        here = F.coalesce(place, F.lit(False)) & F.col(BATCH).isin([part.batch for part in parts])
        wanted = wanted | here
        number = F.when(here, F.lit(batch).cast("long")).otherwise(number)
    rows = spark.table(table).where(wanted)
    keys = list(next(iter(into)).values)
    replace_partitions(rebalanced(rows.withColumn(BATCH, number), keys), table)


def _drop(spark: SparkSession, table: str, parts: list[Partition]) -> None:
    for part in parts:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({part.spec()})")


def _location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
