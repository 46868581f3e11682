"""Removal of repeated passages: exact substring dedup by merging shard suffix orders.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier in the corpus
(a smaller id, or the same document further left). Matches never cross documents, and strings
are judged on the input.

1. Every window of ``length`` bytes is filed under its minimizer, the ``gram``-byte string in it
   with the smallest hash. Equal windows have equal minimizers, so they meet under one key
   wherever they stand; neighbouring windows mostly share one and travel as one run. No window
   is left out.
2. Runs whose bytes are equal fall together, first per task and then per key, so a passage in a
   third of all documents costs a row per task: the first one stands for all, the others are
   spans to remove.
3. Where a key has several different runs, their texts are fetched, gathered in key order into
   bundles of shards, and the shards' Burrows-Wheeler transforms are merged by interleave
   refinement (``bwt.repeated``). Intervals with a common prefix of ``length`` or more are the
   repeated strings; in each the earliest place stays. A key with very many different runs is
   split first, by where its minimizer stands in a window and by the bytes all such windows
   share, so a large group of near copies spreads over tasks. Equal parts fall together like runs,
   and a finer key that is still crowded is split into single windows, of which equal ones meet.
4. Spans are merged per document and cut.

Steps are written to the shared folder. Tasks hold one bundle at a time; a bundle ends at a key's
end, so its size is set by ``BUNDLE_BYTES`` and by ``CROWD`` different parts of a key.

Defined results: null and short texts keep all their bytes. Rows that are equal in id and text
are one document and have the same result; an id names one text. Rows without an id are left
whole and remove nothing. Other columns are ignored, whatever their names. Runs are compared by
two 64-bit hashes, windows in the merge by their bytes.
"""

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.llm.bwt import repeated
from ringledger.llm.frames import packed
from ringledger.operators.staging import staged

LENGTH = 100
GRAM = 32
# Texts are hashed in groups of about so many bytes; equal runs of so many groups fall together
# before anything is shuffled.
GROUP_BYTES = 1 << 19
GROUPS = 16
BUNDLE_BYTES = 1 << 18
# Equal parts among about so many bytes of a task fall together before they are shuffled.
PARTS_BYTES = 1 << 24
# A key with more different runs than this is split into finer ones, each of the windows in which
# the minimizer stands at one of so many neighbouring places.
CROWD = 500
PART_PLACES = 8
# Positions share a word with hashes while minima are sought.
PLACE_BITS = np.uint64(24)
PLACE_MASK = np.uint64((1 << 24) - 1)
# A text has fewer bytes than two to this power.
SPAN_BITS = 40
BASE = 0x9E3779B97F4A7C15 | 1
MIX = np.uint64(0xBF58476D1CE4E5B9)

RUNS = pa.schema([
    ("key", pa.int64()), ("body", pa.int64()), ("id", pa.int64()), ("first", pa.int64()),
    ("size", pa.int32()),
])
RUNS_SQL = "key long, body long, id long, first long, size int"


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the power of 0..n, and the inverses, modulo 2**64."""
    inverse = pow(BASE, -1, 1 << 64)

    def run(factor: int) -> np.ndarray:
        steps = np.full(n + 1, factor, dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return run(BASE), run(inverse)


@cache
def _byte_values() -> np.ndarray:
    return np.frombuffer(
        b"".join(hashlib.sha256(bytes([k])).digest()[:8] for k in range(256)), dtype=np.uint64
    )


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= MIX
    x ^= x >> np.uint64(29)
    x *= MIX
    x ^= x >> np.uint64(32)
    return x


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def runs_of(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one minimizer in texts of ``length`` or more bytes each.

    Returns text number, first byte, size in bytes, key (hash of the minimizer) and body (hash
    of the run's bytes).
    """
    sizes = np.array([len(text) for text in texts], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    powers, inverses = _powers(1 << n.bit_length())
    values = _byte_values()[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    values *= powers[:n]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values, out=sums[1:])
    grams = _mixed((sums[gram:] - sums[:-gram]) * inverses[: n - gram + 1])
    placed = (grams & ~PLACE_MASK) | np.arange(len(grams), dtype=np.uint64)
    least = _sliding_min(placed, length - gram + 1)
    # A window is whole if it ends inside its text.
    opens = np.zeros(n + 1, dtype=np.int8)
    opens[starts] += 1
    opens[starts + sizes - length + 1] -= 1
    whole = np.cumsum(opens[: len(least)], dtype=np.int8) > 0
    edge = np.ones(len(least), dtype=bool)
    edge[1:] = least[1:] != least[:-1]
    edge[starts] = True
    firsts = np.flatnonzero(edge & whole)
    text = np.searchsorted(starts, firsts, side="right") - 1
    ends = np.minimum(np.append(firsts[1:], n), (starts + sizes - length + 1)[text])
    bytes_ = ends - firsts + length - 1
    body = _mixed((sums[firsts + bytes_] - sums[firsts]) * inverses[firsts]
                  + bytes_.astype(np.uint64))
    key = grams[(least[firsts] & PLACE_MASK).astype(np.int64)]
    return text, firsts - starts[text], bytes_, key.view(np.int64), body.view(np.int64)


def _pieces(texts: pa.Array, ids: pa.Array, length: int) -> Iterator[tuple[list, list, list]]:
    """Groups of texts of about GROUP_BYTES: id, first byte, bytes. Longer texts are cut into
    pieces that overlap by one byte less than a window, so that no window is lost or doubled."""
    names, offsets, held, size = [], [], [], 0
    for name, text in zip(ids, texts):
        whole = (text.as_py() or "").encode("utf-8", "surrogatepass")
        if name.as_py() is None or len(whole) < length:
            continue
        for at in range(0, len(whole) - length + 1, GROUP_BYTES):
            piece = whole[at : at + GROUP_BYTES + length - 1]
            names.append(name.as_py())
            offsets.append(at)
            held.append(piece)
            size += len(piece)
            if size >= GROUP_BYTES:
                yield names, offsets, held
                names, offsets, held, size = [], [], [], 0
    if held:
        yield names, offsets, held


def _batch(schema: pa.Schema, *columns: np.ndarray | pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
    )


def _merged(ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans that overlap or touch become one. Sorted by id and first byte."""
    order = np.lexsort((first, ids))
    ids, first, last = ids[order], first[order], (first + size)[order]
    if not len(ids):
        return ids, first, last
    # One number line for all ids, each on a stretch of its own.
    stretch = np.cumsum(np.diff(ids, prepend=ids[0]) != 0) << SPAN_BITS
    reach = np.maximum.accumulate(stretch + last)
    heads = np.ones(len(ids), dtype=bool)
    heads[1:] = (stretch + first)[1:] > reach[:-1]
    starts = np.flatnonzero(heads)
    ends = (reach - stretch)[np.append(starts[1:], len(ids)) - 1]
    return ids[starts], first[starts], ends - first[starts]


def _scanned(batches: Iterator[pa.RecordBatch], length: int, gram: int
             ) -> Iterator[pa.RecordBatch]:
    """The first of equal runs of some groups; the others as spans (``body`` null)."""

    def gathered() -> Iterator[list[tuple]]:
        parts = []
        for batch in batches:
            for names, offsets, held in _pieces(batch.column("text"), batch.column("id"), length):
                text, first, size, key, body = runs_of(held, length, gram)
                parts.append((np.array(names, dtype=np.int64)[text],
                              np.array(offsets, dtype=np.int64)[text] + first, size, key, body))
                if len(parts) == GROUPS:
                    yield parts
                    parts = []
        if parts:
            yield parts

    for parts in gathered():
        ids, first, size, key, body = (np.concatenate(part) for part in zip(*parts))
        order = np.lexsort((first, ids, body, key))
        ids, first, size, key, body = (x[order] for x in (ids, first, size, key, body))
        again = np.zeros(len(ids), dtype=bool)
        again[1:] = (key[1:] == key[:-1]) & (body[1:] == body[:-1])
        # The same place read twice, from equal rows, is no repeat.
        head = np.maximum.accumulate(np.where(again, 0, np.arange(len(ids))))
        twin = again & (ids == ids[head]) & (first == first[head])
        fresh, spans = ~again, again & ~twin
        yield _batch(RUNS, key[fresh], body[fresh], ids[fresh], first[fresh], size[fresh])
        if spans.any():
            found, start, n = _merged(ids[spans], first[spans], size[spans])
            yield _batch(RUNS, _mixed(found.view(np.uint64)).view(np.int64),
                         pa.nulls(len(found), pa.int64()), found, start, n)


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, body, id and first byte: repeats of a run become spans (``key`` null);
    the first of every run stays if its key has other runs. One row is held between batches."""
    held, shown, rep = None, False, (None, None, 0, 0)
    for batch in batches:
        if not batch.num_rows:
            continue
        ready = np.asarray(batch.column("body").is_null())
        plain = {name: np.asarray(batch.column(name).fill_null(0)) for name in RUNS.names}
        if ready.any():
            yield _spans(*(plain[name][ready] for name in ("id", "first", "size")))
        key, body, ids, first, size = (plain[name][~ready] for name in RUNS.names)
        if not len(key):
            continue
        same = np.zeros(len(key), dtype=bool)
        same[1:] = (key[1:] == key[:-1]) & (body[1:] == body[:-1])
        same[0] = (key[0], body[0]) == rep[:2]
        head = np.maximum.accumulate(np.where(same, -1, np.arange(len(key))))
        head_id = np.where(head < 0, rep[2], ids[head])
        head_first = np.where(head < 0, rep[3], first[head])
        repeats = same & ~((ids == head_id) & (first == head_first))
        if repeats.any():
            yield _spans(ids[repeats], first[repeats], size[repeats])
        last = head[-1]
        if last >= 0:
            rep = (key[last], body[last], int(ids[last]), int(first[last]))
        heads = np.flatnonzero(~same)
        if not len(heads):
            continue
        rows = [x[heads] for x in (key, ids, first, size)]
        if held is not None:
            rows = [np.concatenate((h, x)) for h, x in zip(held, rows)]
        keys = rows[0]
        alike = np.zeros(len(keys) + 1, dtype=bool)
        alike[1:-1] = keys[1:] == keys[:-1]
        # The last one waits for what follows; shown: it has an earlier mate already.
        alike[0] = shown
        many = alike[:-1] | alike[1:]
        out = many.copy()
        out[-1] = False
        if out.any():
            yield _batch(DECIDED, *(x[out] for x in rows))
        held, shown = [x[-1:] for x in rows], bool(many[-1])
    if held is not None and shown:
        yield _batch(DECIDED, *held)


DECIDED = pa.schema([
    ("key", pa.int64()), ("id", pa.int64()), ("first", pa.int64()), ("size", pa.int32()),
])
DECIDED_SQL = "key long, id long, first long, size int"


def _spans(ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    ids, first, size = _merged(ids, first, size)
    return _batch(DECIDED, pa.nulls(len(ids), pa.int64()), ids, first, size)


TEXTS = pa.schema([
    ("key", pa.int64()), ("body", pa.int64()), ("id", pa.int64()), ("first", pa.int64()),
    ("bytes", pa.binary()), ("size", pa.int32()), ("split", pa.bool_()),
])
TEXTS_SQL = "key long, body long, id long, first long, bytes binary, size int, split boolean"


def _digest(text: bytes, salt: bytes = b"") -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8, salt=salt).digest(), "big", signed=True)


def _parts(run: bytes, key: int, length: int, gram: int) -> Iterator[tuple[int, int, bytes]]:
    """A crowded key's run in parts: finer key, offset, bytes.

    A part holds the windows in which the minimizer stands within PART_PLACES places of each
    other. They share all but that many bytes around it, and the hash of those is the finer
    key, so equal windows still meet.
    """
    powers, inverses = _powers(1 << len(run).bit_length())
    values = _byte_values()[np.frombuffer(run, dtype=np.uint8)] * powers[: len(run)]
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)))
    grams = _mixed((sums[gram:] - sums[:-gram]) * inverses[: len(run) - gram + 1])
    place = int(np.flatnonzero(grams.view(np.int64) == key)[0])
    last = len(run) - length
    for part in range((place - last) // PART_PLACES, place // PART_PLACES + 1):
        # Windows start at most ``high`` before the minimizer and at least ``low``.
        low, high = part * PART_PLACES, part * PART_PLACES + PART_PLACES - 1
        begin, end = max(0, place - high), min(last, place - low)
        shared = run[place - low : place - high + length]
        yield _digest(shared, part.to_bytes(2, "big")), begin, run[begin : end + length]


def _collapsed(rows: Iterator[tuple[int, int, int, bytes, bool]]) -> Iterator[pa.RecordBatch]:
    """Rows of key, id, first byte, bytes and whether the key was split: equal parts of a key fall
    together, of about PARTS_BYTES at a time. The first stays, the others become spans (``key``
    null)."""

    def written(held: dict, spans: list) -> Iterator[pa.RecordBatch]:
        if held:
            yield _batch(TEXTS, *zip(*(
                (key, _digest(part), name, first, part, len(part), split)
                for (key, part), (name, first, split) in held.items()
            )))
        if spans:
            ids, first, size = _merged(*(np.array(x, dtype=np.int64) for x in zip(*spans)))
            n = len(ids)
            yield _batch(TEXTS, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), ids, first,
                         pa.nulls(n, pa.binary()), size, pa.nulls(n, pa.bool_()))

    held: dict[tuple[int, bytes], tuple[int, int, bool]] = {}
    spans: list[tuple[int, int, int]] = []
    size = 0
    for key, name, first, part, split in rows:
        size += len(part)
        place, other = (name, first), held.get((key, part))
        if other is None or place < other[:2]:
            held[key, part] = (name, first, split)
        if other is not None and place != other[:2]:
            later = max(place, other[:2])
            spans.append((*later, len(part)))
        if size >= PARTS_BYTES:
            yield from written(held, spans)
            held, spans, size = {}, [], 0
    yield from written(held, spans)


def _fetched(batches: Iterator[pa.RecordBatch], length: int, gram: int
             ) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs listed beside each text, in parts for crowded keys."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for name, text, runs in zip(*(batch.column(c) for c in ("id", "text", "runs"))):
                name, whole = name.as_py(), text.as_py().encode("utf-8", "surrogatepass")
                for run in runs.as_py():
                    a, key, split = run["first"], run["key"], bool(run["crowded"])
                    found = whole[a : a + run["size"]]
                    for k, offset, part in (
                        _parts(found, key, length, gram) if split else [(key, 0, found)]
                    ):
                        yield k, name, a + offset, part, split

    return _collapsed(rows())


def _windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Parts of finer keys that are still crowded, window by window: equality alone decides."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for name, first, part in zip(*(batch.column(c).to_pylist()
                                           for c in ("id", "first", "bytes"))):
                for k in range(len(part) - length + 1):
                    window = part[k : k + length]
                    yield _digest(window, b"window"), name, first + k, window, True

    return _collapsed(rows())


def merge_parts(once: DataFrame, length: int, gram: int, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Parts to merge by key, and the spans (``id, first, size``) of their repeats.

    ``once`` has ``id, text, runs``. A key has at most ``crowd`` different parts, or it is the key of
    one window (``alone``), which needs no merge.
    """
    parts = staged(once.mapInArrow(lambda batches: _fetched(batches, length, gram), TEXTS_SQL),
                   "parts")
    # Equal parts of several tasks count once; those of a finer key share most of their bytes.
    crowded = staged(parts.where("split").select("key", "body").distinct().groupBy("key").agg(
        F.count("*").alias("n")
    ).where(F.col("n") > crowd).select("key"), "crowded-parts")
    open_parts = parts.where("key is not null")
    windows = staged(open_parts.where("split").join(crowded, "key").select(*TEXTS.names).mapInArrow(
        lambda batches: _windows(batches, length), TEXTS_SQL
    ), "windows")
    rest = open_parts.where("not split").unionByName(
        open_parts.where("split").join(crowded, "key", "left_anti").select(*TEXTS.names)
    )
    merged = rest.withColumn("alone", F.lit(False)).unionByName(
        windows.where("key is not null").withColumn("alone", F.lit(True))
    )
    spans = parts.unionByName(windows).where("key is null").select("id", "first", "size")
    return merged, spans


SPANS = pa.schema([("id", pa.int64()), ("first", pa.int64()), ("size", pa.int32())])
SPANS_SQL = "id long, first long, size int"


def _later_places(ids: list[int], firsts: list[int], texts: list[bytes], length: int
                  ) -> pa.RecordBatch:
    """Windows of one bundle that stand at an earlier place too."""
    block, string, offset = repeated(texts, length)
    owner = np.array(ids, dtype=np.int64)[string]
    place = np.array(firsts, dtype=np.int64)[string] + offset
    order = np.lexsort((place, owner, block))
    block, owner, place = block[order], owner[order], place[order]
    later = np.zeros(len(block), dtype=bool)
    later[1:] = block[1:] == block[:-1]
    # The same place may be in two runs that were cut apart.
    head = np.maximum.accumulate(np.where(later, 0, np.arange(len(block))))
    later &= (owner != owner[head]) | (place != place[head])
    owner, place = owner[later], place[later]
    return _batch(SPANS, *_merged(owner, place, np.full(len(owner), length)))


def _bundled(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Parts sorted by key, body, id and first byte, in bundles of whole keys; windows to remove.
    Of equal parts the first one is merged only, the others go as they are."""
    ids, firsts, texts, size, last, head = [], [], [], 0, None, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "id", "first", "bytes", "alone")]
        again = []
        for key, name, first, text, alone in zip(*columns):
            if head is not None and head[0] == key and head[3] == text:
                if (name, first) != head[1:3]:
                    again.append((name, first, len(text)))
                continue
            head = (key, name, first, text)
            if alone:
                continue
            if key != last and size >= BUNDLE_BYTES:
                yield _later_places(ids, firsts, texts, length)
                ids, firsts, texts, size = [], [], [], 0
            ids.append(name)
            firsts.append(first)
            texts.append(text)
            size += len(text)
            last = key
        if again:
            yield _batch(SPANS, *_merged(*(np.array(x, dtype=np.int64) for x in zip(*again))))
    if texts:
        yield _later_places(ids, firsts, texts, length)


def repeated_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """``id, first, size``: bytes to remove, in spans that may overlap.

    Keys with more than ``crowd`` different runs are split up; the result is the same."""
    read = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"),
                       F.col(f"`{text_column}`").alias("text"))
    runs = read.mapInArrow(lambda batches: _scanned(batches, length, gram), RUNS_SQL)
    by_key = runs.repartition("key").sortWithinPartitions("key", "body", "id", "first")
    decided = staged(by_key.mapInArrow(_decided, DECIDED_SQL), "runs")
    open_runs = decided.where("key is not null")
    # Written first: few keys, so Spark knows their size and need not shuffle the runs for them.
    crowded = staged(open_runs.groupBy("key").agg(F.count("*").alias("n")).where(
        F.col("n") > crowd
    ).select("key", F.lit(True).alias("crowded")), "crowded")
    wanted = open_runs.join(crowded, "key", "left").groupBy("id").agg(
        F.collect_list(F.struct("key", "first", "size", "crowded")).alias("runs")
    )
    once = read.where("id is not null").join(wanted, "id")
    parts, again = merge_parts(once, length, gram, crowd)
    texts = parts.select("key", "body", "id", "first", "bytes", "alone").repartition("key")
    texts = texts.sortWithinPartitions("key", "body", "id", "first")
    merged = staged(texts.mapInArrow(lambda batches: _bundled(batches, length), SPANS_SQL), "spans")
    return decided.where("key is null").select("id", "first", "size").unionByName(
        again
    ).unionByName(merged)


def _cut(text: str | None, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """What is left, removed bytes, maximal removed runs."""
    whole = (text or "").encode("utf-8", "surrogatepass")
    if not spans:
        return whole, 0, 0
    kept, done, n = [], 0, 0
    for first, size in sorted((span["first"], span["size"]) for span in spans):
        if first > done or not n:
            kept.append(whole[done:first])
            n += 1
        done = max(done, first + size)
    kept.append(whole[done:])
    left = b"".join(kept)
    return left, len(whole) - len(left), n


CUT_SQL = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for name, text, spans in zip(*(batch.column(c) for c in ("id", "text", "spans"))):
            left, removed, n = _cut(text.as_py(), spans.as_py())
            rows.append((name.as_py(), len(left) + removed, removed, n,
                         hashlib.sha256(left).hexdigest()))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()])],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def _gathered(spans: DataFrame) -> DataFrame:
    return spans.groupBy(F.col("id").alias("of_id")).agg(
        F.collect_list(F.struct("first", "size")).alias("spans")
    )


def removals(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    spans = _gathered(repeated_spans(docs, id_column, text_column, length, gram, crowd))
    read = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"),
                       F.col(f"`{text_column}`").alias("text"))
    joined = read.join(spans, F.col("id") == F.col("of_id"), "left").select("id", "text", "spans")
    return joined.mapInArrow(_summed, CUT_SQL)


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` without the repeated bytes; characters cut apart are dropped."""
    spans = _gathered(repeated_spans(docs, id_column, text_column, length, gram))
    schema, names = docs.schema, docs.columns
    met = packed(docs, id=F.col(f"`{id_column}`")).join(
        spans, F.col("id") == F.col("of_id"), "left"
    )
    last = "spans"
    while last in names:
        last += "_"
    joined = met.select("row.*", F.col("spans").alias(last))

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_column)
        for batch in batches:
            columns = batch.columns[: len(names)]
            columns[at] = pa.array([
                _cut(text.as_py(), found)[0].decode("utf-8", "ignore") if (found := spans.as_py())
                else text.as_py()
                for text, spans in zip(batch.column(at), batch.column(len(names)))
            ], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(cleaned, schema)
