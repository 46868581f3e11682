"""Row batches sent to an external service from the tasks, with retries."""

import time
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from ringledger.operators.staging import shared_folder

# Delivers rows; returns (position, message) of those the service refused.
Send = Callable[[list[dict]], list[tuple[int, str]] | None]

# Rows per request and attempts per request.
BATCH_SIZE = 1000
MAX_ATTEMPTS = 5

ERROR = "_error"

Answer = TypeVar("Answer")


class DeliveryError(RuntimeError):
    """Some rows were not delivered; ``path`` names the Parquet folder that holds them."""

    def __init__(self, rows: int, path: str):
        super().__init__(f"{rows} rows were not delivered, see {path}")
        self.rows = rows
        self.path = path


def send_batches(
    df: DataFrame,
    send: Send,
    batch_size: int = BATCH_SIZE,
    max_attempts: int = MAX_ATTEMPTS,
    pause_seconds: float = 0.0,
    dead_letters: str | None = None,
) -> None:
    """Sends every row through ``send``, each partition in batches of ``batch_size``.

    A request that raises is tried again up to ``max_attempts`` times. Rows of a request
    that never succeeds, and rows the service refuses, are stored with the reason in
    ``dead_letters``; when there are any, DeliveryError is raised at the end.

    Delivery is at least once: Spark runs a failed task again, so let the service
    recognise a row it has seen by its key, or use ``delivery.deliver_once``.
    """
    path = dead_letters or shared_folder(df.sparkSession, "dead-letters")
    schema = StructType([*df.schema, StructField(ERROR, StringType(), True)])
    refused = to_arrow_schema(schema)

    def deliver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in regrouped(batches, batch_size):
            failed = _attempt(send, rows, max_attempts, pause_seconds)
            if failed:
                yield pa.RecordBatch.from_pylist(failed, schema=refused)

    df.mapInArrow(deliver, schema).write.mode("overwrite").parquet(path)
    lost = df.sparkSession.read.schema(schema).parquet(path).count()
    if lost:
        raise DeliveryError(lost, path)


def regrouped(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[dict]]:
    """Rows in lists of ``size``, the last one shorter."""
    waiting: list[dict] = []
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            waiting.extend(batch.slice(start, size).to_pylist())
            while len(waiting) >= size:
                yield waiting[:size]
                waiting = waiting[size:]
    if waiting:
        yield waiting


def attempted(request: Callable[[], Answer], max_attempts: int, pause_seconds: float) -> Answer:
    """The answer to a request that is tried again when it raises; raises what the last try did."""
    for attempt in range(max_attempts):
        if attempt and pause_seconds:
            time.sleep(pause_seconds * 2 ** (attempt - 1))
        try:
            return request()
        except Exception:
            if attempt + 1 == max_attempts:
                raise
    raise ValueError("max_attempts must be 1 or more")


def _attempt(
    send: Send, rows: list[dict], max_attempts: int, pause_seconds: float
) -> list[dict]:
    try:
        bad = attempted(lambda: send(rows), max_attempts, pause_seconds)
    except Exception as error:
        return [{**row, ERROR: f"{type(error).__name__}: {error}"} for row in rows]
    return [{**rows[i], ERROR: text} for i, text in bad or []]
