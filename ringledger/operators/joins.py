"""Join of sheet rows with what is known once per file."""

from pyspark.sql import DataFrame

from ringledger.operators.staging import staged


def join_per_file(rows: DataFrame, per_file: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` (path, row, ...) with the columns of ``per_file``, one row per path.

    ``per_file`` is worked out and written first. So its size is known when the join is planned:
    below Spark's broadcast threshold it goes to the rows, which stay where they were read. Beyond
    it both sides are shuffled for the join alone, and a file with most of the rows is split by
    the adaptive skew handling.
    """
    return rows.join(staged(per_file, "per-file"), "path", how)
