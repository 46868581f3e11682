"""Streamed slots: late and repeated rows are kept aside and the counts add up."""

from ringledger.operators.staging import folders
from ringledger.plans.activity import cleaned, hourly_average
from ringledger.streaming.slots import (
    LATE,
    REPEATED,
    batch_notes,
    counted_hours,
    rejected_rows,
    write_slots,
)
from ringledger.schemas import ACTIVITY_TSV

BEGIN = 1383260400000


def _feed(spark, tmp_path, once=False):
    folder, out, state = tmp_path / "slots", str(tmp_path / "hours"), str(tmp_path / "state")
    folder.mkdir()

    def run(name, slots):
        """Takes a file of (square, slot, value) as one batch."""
        (folder / name).write_text("".join(
            f"{square}\t{BEGIN + s * 600_000}\t39\t{value}\t0\t0\t0\t0\n" for square, s, value in slots
        ))
        slots = spark.readStream.schema(ACTIVITY_TSV).option("sep", "\t").csv(str(folder))
        write_slots(cleaned(slots, 2), out, state, once=once).trigger(
            availableNow=True
        ).start().awaitTermination()
        hours = counted_hours(spark, out).orderBy("start").collect()
        return [(r["hourly_average"], r["n_rows"]) for r in hours]

    return run, out, state


def _reasons(spark, out):
    return sorted((r["reason"], r["square_id"]) for r in rejected_rows(spark, out).collect())


def _sums(spark, out):
    notes = batch_notes(spark, out).orderBy("ingest_batch").collect()
    assert all(r["n_read"] == r["n_counted"] + r["n_rejected"] for r in notes)
    return [r["n_read"] for r in notes]


def test_rows_of_closed_hours_land_apart(spark, tmp_path):
    run, out, _ = _feed(spark, tmp_path)
    assert run("a.tsv", [(1, 0, 2), (1, 6, 3)]) == [(2.0, 1), (3.0, 1)]
    # The second hour is open still; rows may come in any order within a batch.
    assert run("b.tsv", [(2, 300, 7), (2, 6, 5), (3, 0, 4)]) == [(3.0, 2), (4.0, 2), (7.0, 1)]
    assert run("c.tsv", [(4, 0, 100), (5, 301, 9), (4, 6, 1)]) == [(3.0, 2), (4.0, 2), (8.0, 2)]
    assert _reasons(spark, out) == [(LATE, 4), (LATE, 4)]
    assert _sums(spark, out) == [2, 3, 3]


def test_without_late_rows_hours_equal_the_batch_plan(spark, tmp_path):
    run, out, _ = _feed(spark, tmp_path)
    rows = [(s % 3, s, s % 5) for s in range(20)]
    run("a.tsv", rows[:12])
    streamed = run("b.tsv", rows[10:])
    whole = hourly_average(cleaned(
        spark.read.schema(ACTIVITY_TSV).option("sep", "\t").csv(str(tmp_path / "slots")), 2
    )).orderBy("start").collect()
    assert [x[0] for x in streamed] == [r["hourly_average"] for r in whole]
    assert rejected_rows(spark, out).count() == 0


def test_slots_delivered_twice_count_once(spark, tmp_path):
    run, out, _ = _feed(spark, tmp_path, once=True)
    assert run("a.tsv", [(1, 0, 2), (1, 0, 2), (2, 0, 4)]) == [(3.0, 2)]
    assert run("b.tsv", [(1, 0, 2), (3, 1, 6), (4, 300, 1)]) == [(4.0, 3), (1.0, 1)]
    assert _reasons(spark, out) == [(REPEATED, 1), (REPEATED, 1)]
    # A repeated slot of a closed hour is late; the names of closed hours are forgotten.
    run("c.tsv", [(1, 0, 2), (4, 300, 1), (5, 301, 1)])
    assert _reasons(spark, out) == [(LATE, 1), (REPEATED, 1), (REPEATED, 1), (REPEATED, 4)]
    assert _sums(spark, out) == [3, 3, 3]
    assert sorted(folders(spark, f"{out}/slots")) == ["ingest_batch=1", "ingest_batch=2"]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    run, out, state = _feed(spark, tmp_path, once=True)
    run("a.tsv", [(1, 0, 2), (1, 6, 3)])
    first = run("b.tsv", [(1, 0, 2), (2, 300, 7)])
    before = sorted(map(str, rejected_rows(spark, out).collect()))
    # As after a crash between the writes of the second batch and its commit.
    for name in ("1", ".1.crc"):
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    assert run("b.tsv", [(1, 0, 2), (2, 300, 7)]) == first
    assert sorted(map(str, rejected_rows(spark, out).collect())) == before
    assert _sums(spark, out) == [2, 2]
