"""Language identification by prediction by partial matching (PPM).

Every language has a byte context tree: how often each byte followed each context of up to
``ORDER`` bytes in its training texts. A byte's code length is taken at the longest context the
tree knows. There a byte seen before costs by its share, with the number of different bytes seen
counted in as the share of the escape (method C); an unseen byte costs the escape and is coded
again in the context that is one byte shorter, without the bytes that the longer one had seen
(exclusion). Below the empty context all bytes left are equally likely. So the lengths of all 256
bytes always are those of a whole distribution. Trees stay frozen while texts are scored, and a
text starts as if line feeds stood before it.

A byte seen in a context was seen in all shorter ones, so what is excluded depends on the next
longer context alone, and a length is a sum of parts that hang on one context and one byte each.
Lengths of all windows of ``ORDER + 1`` bytes that any tree knows are worked out once and looked
up; other windows are worked out when met. Lengths are kept in whole 65536ths of a bit, so a
text's total does not depend on the order of adding up. The prediction is the language with the
shortest code, its score the probability that follows from the lengths if all languages are
equally likely beforehand.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is everything
where no language was learned. Long texts are scored whole, in pieces. Of languages with the same
length the first by name is taken. Repeated rows give repeated results, an empty table an empty
result. Other columns are not read, whatever their names; training rows without a text or a
language are left out.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringledger.operators.staging import staged

ORDER = 4
# Training bounds: documents of a language, and bytes of one that is preferred; longer documents
# are drawn only where a language has too few others.
TRAIN_DOCS = 400
TRAIN_BYTES = 20_000
UNIT = 1 << 16
PIECE = 1 << 20
START = b"\n"
UNKNOWN = "und"


def windows(data: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Every window of ``order + 1`` bytes as one number."""
    n = max(0, len(data) - order)
    found = np.zeros(n, dtype=np.uint64)
    for k in range(order + 1):
        found = found << np.uint64(8) | data[k : k + n].astype(np.uint64)
    return found


def _place(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each number stands among the sorted keys, -1 for those that do not."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _tail(grams: np.ndarray, n_bytes: int) -> np.ndarray:
    return grams & np.uint64((1 << 8 * n_bytes) - 1)


def _gathered(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, first = np.unique(keys[order], return_index=True)
    return keys, np.add.reduceat(values[order], first) if len(keys) else values


class Tree:
    """Byte counts of one language below contexts of all orders, and their code lengths."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int = ORDER):
        self.order = order
        self.grams, self.counts, self.contexts = [], [], []
        self.sums, self.kinds, self.left_sums, self.left_kinds = [], [], [], []
        for j in range(order + 1):
            keys, n = _gathered(_tail(grams, j + 1), counts.astype(np.int64))
            contexts, first = np.unique(keys >> np.uint64(8), return_index=True)
            kinds = np.diff(np.append(first, len(keys)))
            sums = np.add.reduceat(n, first) if len(first) else n
            left_sums, left_kinds = sums, kinds
            if j and len(keys):
                # What the context one byte shorter has beside the bytes seen here.
                same = self.counts[j - 1][_place(self.grams[j - 1], _tail(keys, j))]
                shorter = _place(self.contexts[j - 1], _tail(contexts, j - 1))
                left_sums = self.sums[j - 1][shorter] - np.add.reduceat(same, first)
                left_kinds = self.kinds[j - 1][shorter] - kinds
            for held, new in (
                (self.grams, keys), (self.counts, n), (self.contexts, contexts), (self.sums, sums),
                (self.kinds, kinds), (self.left_sums, left_sums), (self.left_kinds, left_kinds),
            ):
                held.append(new)

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each window after the others, in bits."""
        bits = np.zeros(len(grams))
        open_, longer = np.arange(len(grams)), np.full(len(grams), -1)
        for j in range(self.order, -1, -1):
            now = grams[open_]
            at = _place(self.contexts[j], _tail(now >> np.uint64(8), j))
            sums, kinds = np.zeros(len(now), np.int64), np.zeros(len(now), np.int64)
            fresh, after = (at >= 0) & (longer < 0), longer >= 0
            sums[fresh], kinds[fresh] = self.sums[j][at[fresh]], self.kinds[j][at[fresh]]
            if after.any():
                sums[after] = self.left_sums[j + 1][longer[after]]
                kinds[after] = self.left_kinds[j + 1][longer[after]]
            place = _place(self.grams[j], _tail(now, j + 1))
            seen = place >= 0
            share = np.where(seen, self.counts[j][place] if len(self.counts[j]) else 0, kinds)
            told = share > 0
            bits[open_[told]] += np.log2((sums + kinds)[told] / share[told])
            open_, longer = open_[~seen], at[~seen]
        left = 256 - (int(self.kinds[0][0]) if len(self.kinds[0]) else 0)
        bits[open_] += np.log2(max(left, 1))
        return bits


class Model:
    """The trees of all languages."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER):
        self.order, self.languages = order, sorted(counts)
        self.trees = [Tree(*counts[name], order) for name in self.languages]
        known = [tree.grams[order] for tree in self.trees]
        self.known = np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        self.table = self._units(self.known)

    def _units(self, grams: np.ndarray) -> np.ndarray:
        rows = [np.rint(tree.lengths(grams) * UNIT).astype(np.int64) for tree in self.trees]
        return np.stack(rows, axis=1) if rows else np.zeros((len(grams), 0), dtype=np.int64)

    def totals(self, texts: Sequence[bytes]) -> np.ndarray:
        """Code length of every text (row) by every language (column), in units."""
        total = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        held, size = [], 0
        for k, text in enumerate(texts):
            whole = START * self.order + text
            for first in range(0, len(text), PIECE):
                piece = whole[first : first + self.order + PIECE]
                held.append((k, piece))
                size += len(piece)
                if size >= PIECE:
                    self._add(held, total)
                    held, size = [], 0
        if held:
            self._add(held, total)
        return total

    def _add(self, pieces: list[tuple[int, bytes]], total: np.ndarray) -> None:
        sizes = np.array([len(piece) for _, piece in pieces])
        starts = np.cumsum(sizes) - sizes
        grams = windows(np.frombuffer(b"".join(piece for _, piece in pieces), np.uint8), self.order)
        at = _place(self.known, grams)
        units = self.table[at]
        missed = np.flatnonzero(at < 0)
        if len(missed):
            new, which = np.unique(grams[missed], return_inverse=True)
            units[missed] = self._units(new)[which]
        # Windows over the end of a piece belong to none.
        sums = np.concatenate((np.zeros((1, units.shape[1]), np.int64), np.cumsum(units, axis=0)))
        found = sums[starts + sizes - self.order] - sums[starts]
        np.add.at(total, [k for k, _ in pieces], found)

    def predicted(self, texts: Sequence[bytes]) -> list[tuple[str, float]]:
        """Language and score of every text."""
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        total = self.totals(texts)
        best = total.argmin(axis=1)
        behind = (total - total.min(axis=1, keepdims=True)) / UNIT
        scores = 1 / np.exp2(-behind).sum(axis=1)
        return [(self.languages[k], float(s)) for k, s in zip(best, scores)]


def _sampled(labelled: DataFrame, train_docs: int, train_bytes: int) -> DataFrame:
    """The texts of at most ``train_docs`` rows of every language, picked by a hash of the text.

    Hashes alone are ranked, so that a language of most rows sends its few best ones of every task
    to one, and no texts. Copies of a text count as so many rows and are learned once.
    """
    key = F.xxhash64("text").alias("key")
    order = Window.partitionBy("lang").orderBy("long", "key")
    ranks = labelled.select("lang", (F.octet_length("text") > train_bytes).alias("long"), key)
    picked = staged(ranks.withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= train_docs
    ).select("lang", "key").distinct(), "picked")
    return labelled.select("lang", "text", key).join(picked, ["lang", "key"], "left_semi").groupBy(
        "lang", "key").agg(F.min("text").alias("text")).select("lang", "text")


def learned(docs: DataFrame, text_column: str = "text", lang_column: str = "lang",
            order: int = ORDER, train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES
            ) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Window counts of every language of ``docs``, which ``Model`` is made of.

    Windows are counted where the texts are; the driver gets a row per language and distinct
    window of the bounded sample.
    """
    labelled = docs.select(
        F.col(f"`{lang_column}`").cast("string").alias("lang"),
        F.col(f"`{text_column}`").alias("text"),
    ).where("lang is not null and text is not null")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                data = START * order + text.as_py().encode("utf-8", "surrogatepass")
                grams, n = np.unique(windows(np.frombuffer(data, np.uint8), order), return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang.as_py()] * len(grams), pa.string()),
                    "gram": grams.view(np.int64), "n": n.astype(np.int64),
                })

    counts = _sampled(labelled, train_docs, train_bytes).mapInArrow(
        counted, "lang string, gram long, n long"
    ).groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    lang = counts.column("lang").combine_chunks().dictionary_encode()
    codes = lang.indices.to_numpy()
    grams, n = counts.column("gram").to_numpy().view(np.uint64), counts.column("n").to_numpy()
    return {
        name: (grams[codes == k], n[codes == k]) for k, name in enumerate(lang.dictionary.to_pylist())
    }


def predicted(docs: DataFrame, counts: dict[str, tuple[np.ndarray, np.ndarray]],
              id_column: str = "doc_id", text_column: str = "text", order: int = ORDER
              ) -> DataFrame:
    """``id, lang_pred, score`` of every row of ``docs``."""
    text = F.col(f"`{text_column}`")
    read = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        # Texts without a letter need not be scored.
        F.when(text.rlike(r"\p{L}"), text).alias("text"),
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(counts, order)
        for batch in batches:
            texts = batch.column("text")
            told = [k for k, text in enumerate(texts) if text.is_valid]
            found = [(UNKNOWN, 0.0)] * len(texts)
            scored = model.predicted([
                texts[k].as_py().encode("utf-8", "surrogatepass") for k in told
            ])
            for k, one in zip(told, scored):
                found[k] = one
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"),
                "lang_pred": pa.array([name for name, _ in found], pa.string()),
                "score": pa.array([score for _, score in found], pa.float64()),
            })

    kind = read.schema["id"].dataType.simpleString()
    return read.mapInArrow(rows, f"id {kind}, lang_pred string, score double")
