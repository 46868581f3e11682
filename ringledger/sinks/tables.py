"""Stored ORC tables: create, append by name, replace whole partitions."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def create_table(spark: SparkSession, table: str, schema: StructType) -> None:
    """Empty ORC table of a schema; raises when the table exists."""
    spark.createDataFrame([], schema).writeTo(table).using("orc").create()


def ensure_table(
    spark: SparkSession, table: str, schema: StructType, partition_by: list[str]
) -> None:
    """ORC table of a schema, partitioned, unless it exists already."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING orc{layout}")


def append_table(
    df: DataFrame,
    table: str,
    partition_by: list[str] | None = None,
    rebalance: bool = False,
    **options: str,
) -> None:
    """Appends to an ORC table, created when absent; columns are matched by name.

    ``rebalance`` first gathers the rows of each partition, see ``rebalanced``.
    """
    if rebalance and partition_by:
        df = rebalanced(df, partition_by)
    writer = df.write.format("orc").mode("append").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def rebalanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows gathered by partition with one more shuffle, for few and even files.

    Worth it when every task holds rows of many partitions. A partition with most of the
    rows is split over tasks, small ones share a task.
    """
    return df.hint("rebalance", *[F.col(name) for name in partition_by])


def append_counted(df: DataFrame, table: str, partition_by: list[str] | None = None) -> int:
    """Appends and returns the number of rows written, counted by the write itself."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    append_table(counted, table, partition_by)
    return seen.get["rows"]


def replace_partitions(df: DataFrame, table: str) -> None:
    """Writes rows so that each partition they touch holds exactly them afterwards.

    Repeating a write after a failure leaves the same content, where repeating an append
    would double it.
    """
    spark = df.sparkSession
    with _dynamic_overwrite(spark):
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)
