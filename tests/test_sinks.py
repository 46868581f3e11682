"""Stored tables, batched delivery with retries, and the table copy."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ringledger.operators.staging import shared_folder
from ringledger.plans.copy import copy_to_service, copy_to_table, table_copy
from ringledger.sinks import compaction
from ringledger.sinks.batches import DeliveryError, send_batches
from ringledger.sinks.tables import (
    append_counted,
    append_table,
    create_table,
    ensure_table,
    replace_partitions,
)

SCHEMA = StructType([
    StructField("k", LongType()), StructField("v", StringType()), StructField("p", LongType()),
])


def _numbers(spark, start, end, p=0):
    return spark.range(start, end, 1, 3).select(
        F.col("id").alias("k"), F.col("id").cast("string").alias("v"),
        F.lit(p).cast("long").alias("p"),
    )


def test_append_matches_columns_by_name(spark):
    append_table(_numbers(spark, 0, 5), "appended", ["p"])
    append_table(_numbers(spark, 5, 9, p=1).select("p", "v", "k"), "appended", ["p"])
    rows = sorted((r["k"], r["v"], r["p"]) for r in spark.table("appended").collect())
    assert rows == [(i, str(i), int(i >= 5)) for i in range(9)]


def test_append_counts_what_it_writes(spark):
    assert append_counted(_numbers(spark, 0, 7), "counted") == 7
    assert append_counted(_numbers(spark, 0, 0), "counted") == 0
    assert spark.table("counted").count() == 7


def test_rebalanced_append_keeps_every_row(spark):
    append_table(_numbers(spark, 0, 100), "rebalanced", ["p"], rebalance=True)
    assert spark.table("rebalanced").count() == 100


def test_create_refuses_an_existing_table(spark):
    create_table(spark, "created", SCHEMA)
    assert spark.table("created").schema.names == SCHEMA.names
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        create_table(spark, "created", SCHEMA)
    ensure_table(spark, "created", SCHEMA, [])


def test_replacing_partitions_can_be_repeated(spark):
    ensure_table(spark, "replaced", SCHEMA, ["p"])
    for _ in range(2):
        replace_partitions(_numbers(spark, 0, 5, p=1), "replaced")
        replace_partitions(_numbers(spark, 5, 9, p=2), "replaced")
    assert spark.table("replaced").count() == 9
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def _service(folder, fail_first=0, refuse=()):
    """A service that notes its requests as files; tasks may run in other processes."""
    folder = str(folder)

    def send(rows):
        keys = [row["k"] for row in rows]
        tries = os.path.join(folder, f"try-{min(keys)}-{uuid.uuid4().hex}")
        open(tries, "w").close()
        seen = [n for n in os.listdir(folder) if n.startswith(f"try-{min(keys)}-")]
        if len(seen) <= fail_first:
            raise ConnectionError("away")
        with open(os.path.join(folder, f"got-{uuid.uuid4().hex}"), "w") as out:
            json.dump([k for k in keys if k not in refuse], out)
        return [(i, "bad row") for i, k in enumerate(keys) if k in refuse]

    return send


def _received(folder):
    return [json.loads(f.read_text()) for f in folder.glob("got-*")]


def test_batches_are_full_but_for_the_last(spark, tmp_path):
    send_batches(_numbers(spark, 0, 2500).coalesce(1), _service(tmp_path), batch_size=1000)
    batches = _received(tmp_path)
    assert sorted(map(len, batches)) == [500, 1000, 1000]
    assert sorted(k for batch in batches for k in batch) == list(range(2500))


def test_failed_requests_are_tried_again(spark, tmp_path):
    send_batches(_numbers(spark, 0, 10).coalesce(1), _service(tmp_path, fail_first=4))
    assert _received(tmp_path) == [list(range(10))]


def test_what_cannot_be_delivered_is_kept(spark, tmp_path):
    service = _service(tmp_path, fail_first=9)
    with pytest.raises(DeliveryError) as raised:
        send_batches(_numbers(spark, 0, 30).coalesce(1), service, batch_size=10)
    kept = spark.read.parquet(raised.value.path)
    assert raised.value.rows == 30
    assert sorted(r["k"] for r in kept.collect()) == list(range(30))
    assert kept.first()["_error"] == "ConnectionError: away"
    assert len(list(tmp_path.glob("try-*"))) == 3 * 5


def test_refused_rows_are_kept_and_the_others_delivered(spark, tmp_path):
    with pytest.raises(DeliveryError) as raised:
        send_batches(_numbers(spark, 0, 30), _service(tmp_path, refuse={4, 17}))
    kept = spark.read.parquet(raised.value.path).collect()
    assert sorted((r["k"], r["_error"]) for r in kept) == [(4, "bad row"), (17, "bad row")]
    assert sorted(k for batch in _received(tmp_path) for k in batch) == [
        k for k in range(30) if k not in (4, 17)
    ]


TARGET = StructType([StructField("k", LongType()), StructField("v", DoubleType())])


def test_copy_creates_loads_and_keeps_misfits(spark):
    described = spark.createDataFrame(
        [("k", "bigint(20)", "NO"), ("v", "decimal(10,2)", "YES"), ("t", "datetime", "YES")],
        "Field string, Type string, `Null` string")
    source = spark.createDataFrame(
        [("1", "1.25", None), ("2", "x", "2018-01-01 00:00:00"), (None, "2", None), ("3", None, "soon")],
        "k string, v string, t string")
    assert copy_to_table(source, described, "copied", exact_decimals=True) == 3
    assert [(r["k"], str(r["v"]), r["t"]) for r in spark.table("copied").collect()] == [(1, "1.25", None)]
    assert spark.table("copied").schema["v"].dataType.simpleString() == "decimal(10,2)"
    assert sorted(str(r["k"]) for r in spark.table("copied_misfits").collect()) == ["2", "3", "None"]
    with pytest.raises(Exception, match="exists|EXISTS"):
        copy_to_table(source, described, "copied")


def test_staging_on_a_cluster_needs_a_shared_folder():
    class Context:
        master, applicationId = "spark://somewhere", "a"

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(), "x")


def test_copy_maps_types_and_limits(spark, tmp_path):
    source = _numbers(spark, 0, 50)
    assert table_copy(source, TARGET).count() == 50
    limited = table_copy(source, TARGET, limit=7, key="k").collect()
    assert sorted((r["k"], r["v"]) for r in limited) == [(i, float(i)) for i in range(7)]
    with pytest.raises(ValueError):
        table_copy(source, TARGET, limit=7)
    copy_to_service(source, TARGET, _service(tmp_path), limit=12, key="k", batch_size=5)
    assert sorted(k for batch in _received(tmp_path) for k in batch) == list(range(12))


def _landed(spark, database, batches):
    """A landed table with a small partition per batch and period, all taken in."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    table = f"{database}.bills"
    spark.sql(f"CREATE TABLE {table} (v int, billing_year int, billing_month string, feed string, "
              "ingest_batch long) USING orc PARTITIONED BY (billing_year, billing_month, feed, ingest_batch)")
    rows = [(10 * b + k, *period, "f", b) for b in range(batches) for k, period in enumerate(
        [(2018, "January"), (2018, "March"), (None, None)])]
    frame = spark.createDataFrame(rows, "v int, billing_year int, billing_month string, feed string, "
                                  "ingest_batch long")
    append_table(frame, table, ["billing_year", "billing_month", "feed", "ingest_batch"])
    progress = spark.createDataFrame([("m", "f", b) for b in range(batches - 1)],
                                     "mart string, feed string, ingest_batch long")
    append_table(progress, f"{database}.mart_progress")
    return table


def _held(rows):
    return sorted(map(str, rows.select("v", "billing_year", "billing_month", "feed").collect()))


def _folders(spark, table):
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def test_small_closed_partitions_are_merged(spark):
    table = _landed(spark, "compact_a", 12)
    before = _held(spark.table(table))
    assert compaction.compact(spark, "compact_a", table, ["m"]) == 33
    # One partition a period for the closed batches, and the open batch as it was.
    batches = [int(folder.rpartition("=")[2]) for folder in _folders(spark, table)]
    assert sorted(batches) == [-3, -2, -1, 11, 11, 11]
    assert len(_folders(spark, table)) == 6
    assert len(spark.table(table).where("ingest_batch < 0").inputFiles()) == 3
    assert _held(spark.table(table)) == _held(compaction.landed_rows(spark, "compact_a", table)) == before
    progress = spark.table("compact_a.mart_progress")
    fresh = spark.table(table).select("feed", "ingest_batch").distinct().join(
        progress, ["feed", "ingest_batch"], "left_anti")
    assert fresh.collect() == [("f", 11)]
    # A later run merges the merged ones with what has been closed since.
    append_table(spark.createDataFrame([("m", "f", 11)], progress.schema), "compact_a.mart_progress")
    assert compaction.compact(spark, "compact_a", table, ["m"]) == 6
    assert len(_folders(spark, table)) == 3 and _held(spark.table(table)) == before
    assert compaction.compact(spark, "compact_a", table, ["m"]) == 0


@pytest.mark.parametrize("step", ["_note", "_merge", "append_table", "_drop"])
def test_a_compaction_that_stops_loses_and_doubles_nothing(spark, monkeypatch, step):
    database = f"compact{step}"
    table = _landed(spark, database, 4)
    before = _held(spark.table(table))
    real, calls = getattr(compaction, step), []

    def stopping(*args):
        calls.append(args)
        # Dropping begins with what an earlier run left: nothing here.
        if step != "_drop" or args[2]:
            raise RuntimeError("stopped")
        return real(*args)

    if step == "append_table":  # the commit, not the note of the marts
        monkeypatch.setattr(compaction, "_note", lambda *args: None)
    monkeypatch.setattr(compaction, step, stopping)
    with pytest.raises(RuntimeError):
        compaction.compact(spark, database, table, ["m"])
    assert calls and _held(compaction.landed_rows(spark, database, table)) == before
    monkeypatch.undo()
    compaction.compact(spark, database, table, ["m"])
    assert _held(compaction.landed_rows(spark, database, table)) == before == _held(spark.table(table))
    assert len(_folders(spark, table)) == 6


def test_bins_hold_what_fits():
    parts = {compaction.Partition(f"p={p}/feed=f/ingest_batch={b}"): size
             for p, b, size in [(1, 0, 40), (1, 1, 40), (1, 2, 30), (1, 3, 55), (1, 4, 9), (2, 0, 9)]}
    found = compaction.bins(parts, 100)
    assert [[part.batch for part in one] for one in found] == [[0, 1, 4]]
    assert compaction.bins({}, 100) == []
