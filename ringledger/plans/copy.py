"""Copy of a relational table to a warehouse: mapped types, row limit, batched delivery."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ringledger.operators.numbering import first_rows
from ringledger.sinks.batches import BATCH_SIZE, Send, send_batches
from ringledger.sinks.delivery import Service, deliver_once
from ringledger.sinks.tables import append_counted, append_table, create_table
from ringledger.sources.relational import target_schema


def to_target(df: DataFrame, target: StructType) -> DataFrame:
    """Columns of the source under the mapped types; a value that does not fit is NULL."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in target])


def table_copy(
    df: DataFrame, target: StructType, limit: int = 0, key: str | None = None
) -> DataFrame:
    """Rows to copy: all of them, or the first ``limit`` by ``key``."""
    if limit and key is None:
        raise ValueError("a limit needs the key that orders the rows")
    rows = first_rows(df, limit, key) if limit else df
    return to_target(rows, target)


def misfits(df: DataFrame, target: StructType) -> DataFrame:
    """Rows with a value that does not fit its target type, or none where one is required."""
    return df.where(_lost(target))


def _lost(target: StructType) -> Column:
    lost = F.lit(False)
    for field in target:
        gone = F.col(field.name).try_cast(field.dataType).isNull()
        lost = lost | (gone & F.col(field.name).isNotNull() if field.nullable else gone)
    return lost


def copy_to_table(
    df: DataFrame,
    described: DataFrame,
    table: str,
    limit: int = 0,
    key: str | None = None,
    exact_decimals: bool = False,
) -> int:
    """Creates the target table from the source's description and loads it.

    Rows with values that do not fit go as they are to ``<table>_misfits`` instead, which
    exists only if there are any; returns how many. Raises when the table exists.
    """
    spark = df.sparkSession
    target = target_schema(described, exact_decimals)
    if limit and key is None:
        raise ValueError("a limit needs the key that orders the rows")
    rows = first_rows(df, limit, key) if limit else df
    create_table(spark, table, target)
    bad = misfits(rows, target)
    lost = append_counted(bad, f"{table}_misfits") if not bad.isEmpty() else 0
    append_table(to_target(rows.where(~_lost(target)), target), table)
    return lost


def copy_to_service(
    df: DataFrame,
    target: StructType,
    send: Send,
    limit: int = 0,
    key: str | None = None,
    batch_size: int = BATCH_SIZE,
) -> None:
    """Copies a table to a service that takes rows in batches."""
    send_batches(table_copy(df, target, limit, key), send, batch_size)


def copy_once_to_service(
    df: DataFrame,
    target: StructType,
    service: Service,
    delivery: str,
    limit: int = 0,
    key: str | None = None,
    batch_size: int = BATCH_SIZE,
) -> int:
    """Copies a table to a service that makes a whole delivery visible once; returns the rows."""
    return deliver_once(table_copy(df, target, limit, key), service, delivery, batch_size)
