"""Relational tables over JDBC and the mapping of their column types."""

import re
from datetime import date
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from ringledger.schemas import FALLBACK_WAREHOUSE_TYPE, SPARK_TYPES, WAREHOUSE_TYPES


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    key: str | None = None,
    partitions: int | None = None,
    even: bool = False,
) -> DataFrame:
    """Whole table over JDBC.

    With a numeric, date or timestamp ``key`` the read is split into ``partitions`` key
    ranges that executors fetch side by side, of equal width between the lowest and the
    highest key. Where keys cluster, ``even`` asks the source for ranges of equal row
    counts instead, which costs it one ordered pass over the key. Without a key the whole
    table comes through a single connection.
    """
    if key is None:
        return spark.read.jdbc(url, table, properties=properties)
    partitions = partitions or spark.sparkContext.defaultParallelism
    if even:
        query = starts_query(table, key, partitions)
        rows = spark.read.jdbc(url, query, properties=properties).collect()
        predicates = range_predicates(key, [row["start"] for row in rows])
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    bounds = spark.read.jdbc(url, bounds_query(table, key), properties=properties).first()
    if bounds["lo"] is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=bounds["lo"],
        upperBound=bounds["hi"],
        numPartitions=partitions,
        properties=properties,
    )


def bounds_query(table: str, key: str) -> str:
    """Source-side subquery giving the lowest and highest key."""
    return f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) bounds"


def starts_query(table: str, key: str, partitions: int) -> str:
    """Source-side subquery giving the lowest key of each of ``partitions`` equal parts."""
    parts = f"SELECT {key} AS k, NTILE({partitions}) OVER (ORDER BY {key}) AS part FROM {table}"
    return f"(SELECT MIN(k) AS start FROM ({parts}) parts GROUP BY part) starts"


def range_predicates(key: str, starts: list) -> list[str]:
    """Conditions that together take every row once, NULL keys with the first range."""
    cuts = sorted({start for start in starts if start is not None})[1:]
    if not cuts:
        return ["1 = 1"]
    texts = [_literal(cut) for cut in cuts]
    inner = [f"{key} >= {low} AND {key} < {high}" for low, high in pairwise(texts)]
    return [f"{key} < {texts[0]} OR {key} IS NULL", *inner, f"{key} >= {texts[-1]}"]


def _literal(value: object) -> str:
    return f"'{value}'" if isinstance(value, date | str) else str(value)


def columns_query(database: str, table: str) -> str:
    """Source-side subquery listing a table's columns as Field, Type and Null."""
    return (
        "(SELECT column_name AS Field, column_type AS Type, is_nullable AS `Null`, "
        "ordinal_position AS Position FROM information_schema.columns "
        f"WHERE table_schema = '{database}' AND table_name = '{table}') columns_of"
    )


def map_schema(described: DataFrame) -> DataFrame:
    """Warehouse type and mode of described columns (Field, Type, Null).

    The type is looked up by what stands before its length; one without an entry becomes
    text and has ``known`` false.
    """
    base = F.lower(F.substring_index("Type", "(", 1))
    pairs = [F.lit(text) for pair in WAREHOUSE_TYPES.items() for text in pair]
    found = F.try_element_at(F.create_map(*pairs), base)
    return described.withColumns({
        "target_type": F.coalesce(found, F.lit(FALLBACK_WAREHOUSE_TYPE)),
        "mode": F.when(F.col("Null") == "YES", "NULLABLE").otherwise("REQUIRED"),
        "known": found.isNotNull(),
    })


def exact_decimal(type_text: str) -> DecimalType | None:
    """The decimal type a source column declares, where it declares one Spark can hold."""
    found = re.fullmatch(r"decimal\((\d+)(?:,\s*(\d+))?\).*", type_text.lower())
    if found is None:
        return None
    precision, scale = int(found[1]), int(found[2] or 0)
    return DecimalType(precision, scale) if scale <= precision <= 38 else None


def target_schema(described: DataFrame, exact_decimals: bool = False) -> StructType:
    """Spark schema of the target table; reads one row per column of the source table.

    ``exact_decimals`` keeps declared decimals as they are instead of as doubles.
    """
    mapped = map_schema(described)
    if "Position" in described.columns:
        mapped = mapped.orderBy("Position")
    return StructType([
        StructField(
            row["Field"],
            (exact_decimals and exact_decimal(row["Type"])) or SPARK_TYPES[row["target_type"]],
            row["mode"] == "NULLABLE",
        )
        for row in mapped.collect()
    ])
