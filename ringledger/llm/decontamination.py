"""Benchmark decontamination: an FM-index per training shard, searched for test phrases.

A window is ``window`` consecutive words of a benchmark item, or a whole shorter item. Each
task gathers whole documents into shards of a bounded number of words. Words that no item has
can't be part of a window, so a shard's index holds only the runs of item words that are long
enough for the shortest window. All windows are searched backward at once through wavelet-tree
ranks, their places found through sampled suffix positions, and overlapping ones merged into
removal spans.

The benchmark goes to every task, so its size is checked: beyond ``max_benchmark_bytes`` the
call raises and the benchmark has to be given in several parts. The documents are read once
and never shuffled; the memory of a task is set by ``shard_words`` and the longest document.

Defined results: null and empty texts have no words, spans or items; items without words, and
an empty benchmark, match nothing; items without an id are searched but not listed; equal
items are listed under each of their ids. Repeated rows give repeated results.
"""

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.llm.fm_index import FMIndex

WINDOW = 10
SHARD_WORDS = 2_000_000
MAX_BENCHMARK_BYTES = 64 << 20

# A-Z become a-z; what is neither a letter, a digit nor beyond ASCII becomes a blank.
FOLD = bytes(
    byte + 32 if 65 <= byte <= 90
    else byte if byte >= 128 or 48 <= byte <= 57 or 97 <= byte <= 122
    else 32
    for byte in range(256)
)
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
    ]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


class Phrases:
    """The distinct windows of a benchmark by length, and the items each belongs to."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            known = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            for first in range(max(1, len(known) - window + 1) if known else 0):
                named = owners.setdefault(tuple(known[first : first + window]), set())
                if item_id is not None:
                    named.add(item_id)
        self.by_length: dict[int, tuple[np.ndarray, list[list[str]]]] = {}
        for length in sorted({len(phrase) for phrase in owners}):
            same = [phrase for phrase in owners if len(phrase) == length]
            self.by_length[length] = np.array(same), [sorted(owners[phrase]) for phrase in same]
        self.shortest = min(self.by_length, default=0)


class Shard:
    """Whole documents, reduced to the runs of item words that a window fits into."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.n_words = phrases, []
        self.symbols: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.places: list[np.ndarray] = []

    def add(self, text: str | None) -> int:
        found = words(text)
        doc = len(self.n_words)
        self.n_words.append(len(found))
        if not self.phrases.shortest:
            return len(found)
        symbols = np.fromiter(
            map(self.phrases.vocabulary.get, found, repeat(0)), np.int32, len(found)
        )
        edges = np.flatnonzero(np.diff(symbols != 0, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.phrases.shortest
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            self.symbols.append(np.append(symbols[a:b], 0))
            self.docs.append(np.full(b - a + 1, doc))
            self.places.append(np.arange(a, b + 1))
        return len(found)

    def search(self) -> tuple[list[list[tuple[int, int]]], list[list[str]]]:
        """Merged spans (first word, last word) and items, by document."""
        spans: list[list[tuple[int, int]]] = [[] for _ in self.n_words]
        items: list[set[str]] = [set() for _ in self.n_words]
        if not self.symbols:
            return spans, [[] for _ in items]
        index = FMIndex(np.concatenate(self.symbols))
        docs, places = np.concatenate(self.docs), np.concatenate(self.places)
        hits = []
        for length, (table, owners) in self.phrases.by_length.items():
            low, high = index.ranges(table)
            sizes = high - low
            phrase = np.repeat(np.arange(len(table)), sizes)
            rows = np.arange(len(phrase)) + np.repeat(low - np.cumsum(sizes) + sizes, sizes)
            at = index.locate(rows)
            hits.append(np.stack([docs[at], places[at], places[at] + length - 1]))
            for doc, k in np.unique(np.stack([docs[at], phrase]), axis=1).T.tolist():
                items[doc].update(owners[k])
        doc, first, last = np.concatenate(hits, axis=1)
        order = np.lexsort((last, first, doc))
        for d, a, b in zip(doc[order].tolist(), first[order].tolist(), last[order].tolist()):
            if spans[d] and a <= spans[d][-1][1] + 1:
                spans[d][-1] = (spans[d][-1][0], max(b, spans[d][-1][1]))
            else:
                spans[d].append((a, b))
        return spans, [sorted(found) for found in items]


def _phrases(benchmark: DataFrame, window: int, limit: int) -> Phrases:
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > limit:
        raise ValueError(
            f"the benchmark has {size} bytes, more than {limit}; give it in several parts"
        )
    rows = benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator()
    return Phrases([(row[0], row[1]) for row in rows], window)


def _shards(
    batches: Iterator[pa.RecordBatch], phrases: Phrases, text_column: str, shard_words: int
) -> Iterator[tuple[list[pa.RecordBatch], Shard]]:
    held, shard, n = [], Shard(phrases), 0
    for batch in batches:
        n += sum(shard.add(text.as_py()) for text in batch.column(text_column))
        held.append(batch)
        if n >= shard_words:
            yield held, shard
            held, shard, n = [], Shard(phrases), 0
    if held:
        yield held, shard


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id",
                  text_column: str = "text", window: int = WINDOW,
                  shard_words: int = SHARD_WORDS,
                  max_benchmark_bytes: int = MAX_BENCHMARK_BYTES) -> DataFrame:
    """``id, n_words, spans, items`` of every row; spans count words from 0, ends included."""
    phrases = _phrases(benchmark, window, max_benchmark_bytes)
    read = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, shard in _shards(batches, phrases, "text", shard_words):
            spans, items = shard.search()
            done = 0
            for batch in held:
                mine = slice(done, done + batch.num_rows)
                done += batch.num_rows
                listed = [[{"first": a, "last": b} for a, b in row] for row in spans[mine]]
                yield pa.RecordBatch.from_arrays([
                    batch.column("id"), pa.array(shard.n_words[mine], pa.int64()),
                    pa.array(listed, SPANS), pa.array(items[mine], pa.list_(pa.string())),
                ], names=["id", *FOUND.names])

    return read.mapInArrow(searched, T.StructType([read.schema["id"], *FOUND.fields]))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` with each span of words replaced by one line feed."""
    whole = text.encode("utf-8", "surrogatepass")
    places = [found.span() for found in WORD.finditer(whole)]
    kept, done = [], 0
    for first, last in spans:
        kept.append(whole[done : places[first][0]])
        done = places[last][1]
    kept.append(whole[done:])
    return b"\n".join(kept).decode("utf-8", "surrogatepass")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text",
                   window: int = WINDOW, shard_words: int = SHARD_WORDS,
                   max_benchmark_bytes: int = MAX_BENCHMARK_BYTES) -> DataFrame:
    """The rows of ``docs`` with all removal spans cut out of their texts."""
    phrases = _phrases(benchmark, window, max_benchmark_bytes)
    names = docs.columns

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, shard in _shards(batches, phrases, text_column, shard_words):
            spans = iter(shard.search()[0])
            for batch in held:
                at = names.index(text_column)
                texts = [
                    without_spans(text.as_py(), cut) if (cut := next(spans)) else text.as_py()
                    for text in batch.column(at)
                ]
                columns = batch.columns
                columns[at] = pa.array(texts, batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(cleaned, docs.schema)
