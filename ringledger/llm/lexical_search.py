"""Ranked lexical search by Block-Max MaxScore over sharded inverted lists.

``indexed`` reads every document once and gathers shards. A shard is written as many small rows:
the documents' ids and lengths, ``SPAN`` a row, under the term "", and a row per term with its list
of postings in compressed blocks. Beside each block stand its last document and, for some ranges
of term frequency, the highest frequency and the shortest document in it. These bound the block's
scores under any corpus statistics, so the index is written before the statistics are known and
stays valid when shards are added. Statistics come from the index: the lengths, and the document
frequency in every row. No row holds a whole shard, so neither a reader's nor a writer's memory
grows with what a shard holds.

``search`` takes the queries in blocks of ``QUERY_BLOCK`` and runs each over all shards. Of a shard
only the documents and the lists that the block asks for are brought together: a task gets its
shards one after the other and keeps a heap per query. A term's bound in a shard is the largest
of its blocks'. Lists are ordered by their bounds; as long
as the bounds of the lowest ones together stay below the heap's smallest score, these are
non-essential: no document is sought there. What the essential lists bring up is kept only if its
score so far and the maxima of the blocks of the non-essential lists that would hold it can reach
the heap, and only then are those blocks decompressed. Heaps of tasks are merged by a ranking per
query. A document that ties with the smallest score is still scored, so ties are decided by id.

Defined results: null and empty texts hold no term and are in no list; a long text is one
document, read whole. Repeated rows are documents of their own, with consecutive ranks. Equal
scores rank by ascending id, those without an id last. An empty table or a query without terms
gives no rows. Queries that share an id are ranked apart. Other columns are not read, whatever
their names.
"""

import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringledger.operators.numbering import number_rows
from ringledger.operators.staging import shared_folder, staged

TERM = rb"[0-9A-Za-z\x80-\xFF]+"
TOP = 20
SCALE = 1_000_000_000
# A shard is closed at so many postings; a longer document is a shard of its own.
SHARD_POSTINGS = 1 << 20
BLOCK = 128
# Documents looked at between two looks at the heap.
SPAN = 1 << 12
QUERY_BLOCK = 1_000
# Ranges of term frequency that have a bound of their own: 1, 2, 3 to 4, and the rest.
LEVELS = (1, 2, 4, np.iinfo(np.int64).max)

# Rows of the index that go to Spark at once.
BATCH = 1 << 13

# ``df``: documents that hold the term, all of the row's under "", which no text holds.
INDEX = (
    "shard string, term string, df int, first int, ids array<long>, lengths array<int>, "
    "n_terms long, blocks binary, payload binary"
)
HITS = "query int, doc_id long, score long"
# Per block: last document, start in the payload, documents, bytes per number, and the levels.
HEAD = np.dtype([
    ("last", "<i4"), ("at", "<i8"), ("n", "<i4"), ("wide", "u1", 2), ("tf", "<i4", len(LEVELS)),
    ("short", "<i4", len(LEVELS)),
])
WIDTHS = [np.dtype("<u1"), np.dtype("<u2"), np.dtype("<u4")]


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text, A-Z in lower case, in order."""
    return re.findall(TERM, (text or "").encode("utf-8", "surrogatepass").lower())


@dataclass
class _Shard:
    """Documents gathered for one row of the index."""

    ids: list = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    names: dict[bytes, int] = field(default_factory=dict)
    term: array = field(default_factory=lambda: array("i"))
    tf: array = field(default_factory=lambda: array("i"))
    size: list[int] = field(default_factory=list)

    def add(self, doc_id: int | None, text: str | None) -> None:
        found = terms_of(text)
        if not found:
            return
        counts = Counter(found)
        self.ids.append(doc_id)
        self.lengths.append(len(found))
        self.size.append(len(counts))
        names = self.names
        self.term.extend([names.setdefault(term, len(names)) for term in counts])
        self.tf.extend(counts.values())

    def row(self) -> dict:
        names = list(self.names)
        rank = np.empty(len(names), dtype=np.int32)
        rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
        term, tf = rank[np.array(self.term)], np.array(self.tf)
        doc = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.size)
        order = np.argsort(term, kind="stable")
        term, tf, doc = term[order], tf[order], doc[order]
        dfs = np.bincount(term, minlength=len(names))
        first = np.concatenate(([0], np.cumsum(dfs)[:-1]))
        cuts = np.concatenate([np.arange(a, a + n, BLOCK) for a, n in zip(first, dfs)])
        heads, payload = _blocks(doc, tf, np.array(self.lengths, dtype=np.int32)[doc], cuts)
        return {
            "ids": self.ids, "lengths": self.lengths,
            "terms": [name.decode("utf-8", "replace") for name in sorted(names)],
            "dfs": dfs.tolist(), "blocks": heads.tobytes(), "payload": payload,
            "n_terms": int(sum(self.lengths)),
        }


def _blocks(doc: np.ndarray, tf: np.ndarray, length: np.ndarray, cuts: np.ndarray
            ) -> tuple[np.ndarray, bytes]:
    """Heads and bytes of the blocks that start at ``cuts``: gaps between documents, then
    frequencies, each in as few bytes as the block allows."""
    n = np.diff(cuts, append=len(doc))
    heads = np.zeros(len(cuts), dtype=HEAD)
    heads["last"], heads["n"] = doc[cuts + n - 1], n
    low = 0
    for level, high in enumerate(LEVELS):
        inside = (tf > low) & (tf <= high)
        heads["tf"][:, level] = np.maximum.reduceat(np.where(inside, tf, 0), cuts)
        short = np.minimum.reduceat(np.where(inside, length, np.iinfo(np.int32).max), cuts)
        heads["short"][:, level] = np.where(heads["tf"][:, level] > 0, short, 0)
        low = high
    gaps = np.diff(doc, prepend=0)
    gaps[cuts] = doc[cuts]
    for which, values in enumerate((gaps, tf)):
        top = np.maximum.reduceat(values, cuts)
        heads["wide"][:, which] = (top >= 1 << 8).astype(np.uint8) + (top >= 1 << 16)
    each = np.array([wide.itemsize for wide in WIDTHS])[heads["wide"]]
    ends = np.cumsum(n * each.sum(axis=1))
    heads["at"][1:] = ends[:-1]
    payload, at = np.empty(ends[-1], dtype=np.uint8), heads["at"].copy()
    for which, values in enumerate((gaps, tf)):
        wide = np.repeat(each[:, which], n)
        place = np.repeat(at - cuts * each[:, which], n) + np.arange(len(doc)) * wide
        for byte in range(WIDTHS[-1].itemsize):
            some = np.flatnonzero(wide > byte)
            payload[place[some] + byte] = values[some] >> 8 * byte & 255
        at += n * each[:, which]
    return heads, payload.tobytes()


def indexed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
            shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """The shards of the documents, a row per term and some documents, written to the shared
    folder."""
    read = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text")
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            for doc_id, text in zip(batch.column("id"), batch.column("text")):
                shard.add(doc_id.as_py(), text.as_py())
                if len(shard.term) >= shard_postings:
                    row, shard = shard.row(), _Shard()
                    yield from _split(row)
        if shard.ids:
            yield from _split(shard.row())

    return staged(read.mapInArrow(rows, INDEX), "lexical-index")


ARROW_INDEX = pa.schema([
    ("shard", pa.string()), ("term", pa.string()), ("df", pa.int32()), ("first", pa.int32()),
    ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("n_terms", pa.int64()),
    ("blocks", pa.binary()), ("payload", pa.binary()),
])


def _split(row: dict) -> Iterator[pa.RecordBatch]:
    """A shard's rows of the index: its documents, then its terms."""
    name = uuid.uuid4().hex
    for first in range(0, len(row["ids"]), SPAN):
        ids, lengths = (row[x][first : first + SPAN] for x in ("ids", "lengths"))
        yield pa.RecordBatch.from_pylist([{
            "shard": name, "term": "", "df": len(ids), "first": first, "ids": ids,
            "lengths": lengths, "n_terms": sum(lengths),
        }], schema=ARROW_INDEX)
    dfs, heads = np.array(row["dfs"]), np.frombuffer(row["blocks"], dtype=HEAD).copy()
    n_blocks = -(-dfs // BLOCK)
    upto = np.concatenate(([0], np.cumsum(n_blocks)))
    # Where each term's part of the payload starts; its blocks count from there.
    starts = np.append(heads["at"], len(row["payload"]))[upto]
    heads["at"] -= np.repeat(starts[:-1], n_blocks)
    blocks = heads.tobytes()
    for a in range(0, len(dfs), BATCH):
        b = min(a + BATCH, len(dfs))
        found = {
            "shard": pa.array([name] * (b - a)), "term": pa.array(row["terms"][a:b]),
            "df": pa.array(dfs[a:b], pa.int32()),
            "blocks": _cut(blocks, upto[a : b + 1] * HEAD.itemsize),
            "payload": _cut(row["payload"], starts[a : b + 1]),
        }
        yield pa.RecordBatch.from_arrays(
            [found.get(x.name, pa.nulls(b - a, x.type)) for x in ARROW_INDEX], schema=ARROW_INDEX
        )


def _cut(data: bytes, places: np.ndarray) -> pa.Array:
    """The bytes from each of the places to the next."""
    part = data[places[0] : places[-1]]
    offsets = (places - places[0]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(places) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(part)]
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The shards of rows ordered by shard, term and first document, each as ``_Shard.row``
    gives it, with those terms only whose rows are there."""
    name, row, parts = None, {}, []
    for batch in batches:
        columns = {x: batch.column(x) for x in batch.schema.names}
        for k, (shard, term) in enumerate(zip(columns["shard"], columns["term"])):
            if name != (name := shard.as_py()):
                if row:
                    yield _whole(row, parts)
                row, parts = {"ids": [], "lengths": [], "terms": [], "dfs": []}, []
            if term := term.as_py():
                row["terms"].append(term)
                row["dfs"].append(columns["df"][k].as_py())
                parts.append((columns["blocks"][k].as_py(), columns["payload"][k].as_py()))
            else:
                row["ids"] += columns["ids"][k].as_py()
                row["lengths"] += columns["lengths"][k].as_py()
    if row:
        yield _whole(row, parts)


def _whole(row: dict, parts: list[tuple[bytes, bytes]]) -> dict:
    """The row with its terms' blocks and payloads put one after the other."""
    heads = np.frombuffer(b"".join(x for x, _ in parts), dtype=HEAD).copy()
    starts = np.cumsum([0] + [len(x) for _, x in parts])[:-1]
    heads["at"] += np.repeat(starts, [len(x) // HEAD.itemsize for x, _ in parts])
    return row | {"blocks": heads.tobytes(), "payload": b"".join(x for _, x in parts)}


def query_terms(queries: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``item, query, term, times`` per distinct term of every query, with a number per query."""
    read = queries.select(
        F.col(f"`{id_column}`").alias("item"), F.col(f"`{text_column}`").alias("text")
    ).withColumn("query", F.monotonically_increasing_id())
    kind = read.schema["item"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, query, text in zip(*(batch.column(c) for c in ("item", "query", "text"))):
                counts = Counter(terms_of(text.as_py()))
                if counts:
                    yield pa.RecordBatch.from_pydict({
                        "item": pa.array([item.as_py()] * len(counts), item.type),
                        "query": pa.array([query.as_py()] * len(counts), pa.int64()),
                        "term": [term.decode("utf-8", "replace") for term in counts],
                        "times": pa.array(counts.values(), pa.int64()),
                    })

    found = read.select("item", "query", "text").mapInArrow(
        rows, f"item {kind}, query long, term string, times long"
    )
    return staged(found, "query-terms")


def weight(n: Column, df: Column) -> Column:
    """A term's weight among ``n`` documents of which ``df`` hold it."""
    odds = (2 * n + 2).cast("double") / (2 * df + 1).cast("double")
    return F.floor(1000 * F.log(odds)).cast("long")


def saturated(tf: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    """What a posting adds per unit of its term's weight; rises with ``tf``, falls with length."""
    norm = 75 + (25 * length.astype(np.int64) * n) // total
    return (SCALE * tf) // (1000 * tf + 12 * norm)


class _List:
    """Postings of one term in one shard; blocks are decompressed when first asked for."""

    def __init__(self, shard: "_Opened", heads: np.ndarray, df: int, weight: int):
        self.shard, self.heads, self.weight = shard, heads, weight
        n, total = shard.n, shard.total
        each = saturated(heads["tf"].astype(np.int64), heads["short"], n, total)
        self.bounds = weight * each.max(axis=1)
        self.bound = int(self.bounds.max())
        self.last = heads["last"]
        self.first_at = np.concatenate(([0], np.cumsum(heads["n"])))
        self.docs = np.zeros(df, dtype=np.int64)
        self.adds = np.zeros(df, dtype=np.int64)
        self.ready = np.zeros(len(heads), dtype=bool)

    def open(self, blocks: np.ndarray) -> None:
        """Decompresses the blocks, those of them that are not yet."""
        for k in blocks[~self.ready[blocks]].tolist():
            head, data, at = self.heads[k], self.shard.payload, int(self.heads["at"][k])
            a, b = int(self.first_at[k]), int(self.first_at[k + 1])
            wide = WIDTHS[head["wide"][0]]
            docs = np.cumsum(np.frombuffer(data, wide, b - a, at), dtype=np.int64)
            tf = np.frombuffer(
                data, WIDTHS[head["wide"][1]], b - a, at + (b - a) * wide.itemsize
            ).astype(np.int64)
            self.docs[a:b] = docs
            self.adds[a:b] = self.weight * saturated(
                tf, self.shard.lengths[docs], self.shard.n, self.shard.total
            )
            self.ready[k] = True
            self.shard.opened += 1

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``low`` up to ``high``, and what each gets."""
        blocks = np.arange(
            np.searchsorted(self.last, low), min(np.searchsorted(self.last, high) + 1, len(self.last))
        )
        if not len(blocks):
            return self.docs[:0], self.adds[:0]
        self.open(blocks)
        a, b = self.first_at[blocks[0]], self.first_at[blocks[-1] + 1]
        x, y = a + np.searchsorted(self.docs[a:b], [low, high])
        return self.docs[x:y], self.adds[x:y]

    def block_bounds(self, docs: np.ndarray) -> np.ndarray:
        """The maximum of the block that would hold each document."""
        at = np.searchsorted(self.last, docs)
        return np.where(at < len(self.last), self.bounds[np.minimum(at, len(self.last) - 1)], 0)

    def of(self, docs: np.ndarray) -> np.ndarray:
        """What each of the documents gets; only the blocks that could hold them are opened."""
        at = np.searchsorted(self.last, docs)
        inside = at < len(self.last)
        blocks = np.unique(at[inside])
        self.open(blocks)
        found = np.zeros(len(docs), dtype=np.int64)
        for k in blocks.tolist():
            a, b = self.first_at[k], self.first_at[k + 1]
            mine = np.flatnonzero(at == k)
            place = np.minimum(a + np.searchsorted(self.docs[a:b], docs[mine]), b - 1)
            found[mine] = np.where(self.docs[place] == docs[mine], self.adds[place], 0)
        return found


class _Opened:
    """One shard as it is searched."""

    def __init__(self, row: dict, weights: dict[str, int], n: int, total: int):
        self.n, self.total, self.opened = n, total, 0
        self.ids = row["ids"]
        self.lengths = np.asarray(row["lengths"], dtype=np.int64)
        self.payload = row["payload"]
        heads = np.frombuffer(row["blocks"], dtype=HEAD)
        dfs = np.asarray(row["dfs"], dtype=np.int64)
        upto = np.cumsum(-(-dfs // BLOCK))
        self.n_blocks = len(heads)
        self.lists = {}
        for k, term in enumerate(row["terms"]):
            w = weights.get(term)
            if w:
                first = int(upto[k - 1]) if k else 0
                self.lists[term] = _List(self, heads[first : int(upto[k])], int(dfs[k]), w)


@dataclass
class Heap:
    """The best documents of one query so far, those that tie with the last one among them."""

    top: int
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    ids: list = field(default_factory=list)

    @property
    def least(self) -> int:
        """A score below this can't be among the best."""
        return int(self.scores[self.top - 1]) if len(self.ids) >= self.top else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        both = np.concatenate((self.scores, scores))
        names = self.ids + ids
        order = sorted(
            range(len(both)), key=lambda k: (-both[k], names[k] is None, names[k] or 0)
        )[: self.top]
        self.scores, self.ids = both[order], [names[k] for k in order]


def search_shard(shard: _Opened, query: list[tuple[str, int]], heap: Heap) -> None:
    """Puts the shard's best documents for a query (terms with their numbers) into the heap."""
    lists = [(shard.lists[term], times) for term, times in query if term in shard.lists]
    lists.sort(key=lambda x: x[0].bound * x[1])
    reach = np.cumsum([0] + [one.bound * times for one, times in lists])
    for low in range(0, len(shard.ids), SPAN):
        high = min(low + SPAN, len(shard.ids))
        least = heap.least
        # Lists below ``split`` can't lift a document into the heap by themselves.
        split = int(np.searchsorted(reach[1:], least))
        if split == len(lists):
            return
        so_far = np.zeros(high - low, dtype=np.int64)
        for one, times in lists[split:]:
            docs, adds = one.between(low, high)
            so_far[docs - low] += times * adds
        found = np.flatnonzero(so_far)
        scores, found = so_far[found], found + low
        scores, found = _kept(scores, found, lists[:split], least)
        if len(found):
            if len(found) > heap.top:
                best = np.partition(scores, len(scores) - heap.top)[len(scores) - heap.top]
                scores, found = scores[scores >= best], found[scores >= best]
            heap.add(scores, [shard.ids[k] for k in found.tolist()])


def _kept(scores: np.ndarray, docs: np.ndarray, rest: list[tuple[_List, int]], least: int
          ) -> tuple[np.ndarray, np.ndarray]:
    """Documents that reach ``least`` with the non-essential lists, and their whole scores."""
    hopes = [times * one.block_bounds(docs) for one, times in rest]
    hope = sum(hopes, np.zeros(len(docs), dtype=np.int64))
    for k in range(len(rest) - 1, -1, -1):
        near = scores + hope >= least
        scores, docs, hope = scores[near], docs[near], hope[near]
        hopes = [each[near] for each in hopes[: k + 1]]
        if not len(docs):
            return scores, docs
        one, times = rest[k]
        scores, hope = scores + times * one.of(docs), hope - hopes[k]
    near = scores >= least
    return scores[near], docs[near]


def search(index: DataFrame, queries: DataFrame, query_id: str = "item_id",
           query_text: str = "text", top: int = TOP, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, doc_id, score``: the ``top`` best documents of every query.

    Queries go to the tasks in blocks of ``query_block``, one job each, and the driver holds one
    block at a time.
    """
    spark = index.sparkSession
    asked = query_terms(queries, query_id, query_text)
    # A row of two numbers.
    size = index.where(F.col("term") == "").agg(
        F.sum("df").alias("n"), F.sum("n_terms").alias("total")
    ).first()
    n, total = size["n"] or 0, size["total"] or 0
    wanted = asked.select("term").distinct()
    df = index.select("term", "df").join(wanted, "term", "left_semi").groupBy("term").agg(
        F.sum("df").alias("df")
    )
    weighed = staged(
        df.select("term", weight(F.lit(n), F.col("df")).alias("w")).where("w > 0"), "weights"
    )
    each = asked.groupBy("query").agg(F.first("item").alias("item"))
    numbers = staged(number_rows(each, "query", name="k").withColumn("k", F.col("k").cast("int")),
                     "queries")
    ready = staged(asked.select("query", "term", "times").join(weighed, "term").join(
        numbers.select("query", "k"), "query"
    ).groupBy("k").agg(F.collect_list(F.struct("term", "times", "w")).alias("terms")), "asked")
    path = shared_folder(spark, "hits")
    spark.createDataFrame([], HITS).write.parquet(path)
    for first in range(1, numbers.count() + 1, query_block):
        now = ready.where(F.col("k").between(first, first + query_block - 1))
        block = {row["k"]: [tuple(x) for x in row["terms"]] for row in now.collect()}
        if block:
            terms = now.select(F.explode(F.concat("terms.term", F.array(F.lit("")))).alias("term"))
            asked_for = index.join(F.broadcast(terms.distinct()), "term", "left_semi")
            _searched(asked_for, block, n, total, top).write.mode("append").parquet(path)
    hits = spark.read.schema(HITS).parquet(path)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(numbers.select(F.col("k").alias("query"), "item"), "query").select(
        F.col("item").alias(query_id), "rank", "doc_id", "score"
    )


def _searched(index: DataFrame, block: dict[int, list[tuple]], n: int, total: int, top: int
              ) -> DataFrame:
    weights = {term: w for terms in block.values() for term, _, w in terms}
    queries = {k: [(term, times) for term, times, _ in terms] for k, terms in block.items()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = {k: Heap(top) for k in queries}
        for row in _joined(batches):
            shard = _Opened(row, weights, n, total)
            for k, query in queries.items():
                search_shard(shard, query, heaps[k])
        for k, heap in heaps.items():
            if heap.ids:
                yield pa.RecordBatch.from_pydict({
                    "query": pa.array([k] * len(heap.ids), pa.int32()),
                    "doc_id": pa.array(heap.ids, pa.int64()),
                    "score": pa.array(heap.scores, pa.int64()),
                })

    whole = index.drop("n_terms").repartition("shard").sortWithinPartitions(
        "shard", "term", "first"
    )
    return whole.mapInArrow(rows, HITS)


def ranked(docs: DataFrame, queries: DataFrame, id_column: str = "doc_id",
           text_column: str = "text", query_id: str = "item_id", query_text: str = "text",
           top: int = TOP) -> DataFrame:
    """``search`` over an index of ``docs`` made for it."""
    return search(indexed(docs, id_column, text_column), queries, query_id, query_text, top)


ORACLE = f"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), told AS (
  SELECT row_number() OVER () AS d, doc_id, terms, len(terms) AS n FROM lowered WHERE len(terms) > 0
), whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM told
), postings AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM told) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, whole GROUP BY term, docs
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL
), scores AS (
  SELECT item_id, d, any_value(doc_id) AS doc_id, CAST(sum(times * w * ((1000000000 * tf)
         // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN told USING (d), whole
  GROUP BY item_id, d
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)
         AS rank FROM scores WHERE score > 0)
WHERE rank <= {TOP}
"""
