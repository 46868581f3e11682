"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line's evidence is linear in measures of the line and of
its neighbours; neighbouring labels are tied by transition weights. The field is fitted to
documents of known quality, whose lines take the document's label, and to splices of good and
bad documents, which teach the transitions. Forward-backward gives each line's marginal; their
mean, weighted by line length, is calibrated on the training documents and is the score.

Fitting takes at most ``TRAIN_DOCS`` labelled documents of at most ``TRAIN_CHARS`` characters,
those whose ids hash lowest, one in ``HOLD_OUT`` of all ids held out. Scoring reads whole texts
of all documents, in one pass and without a shuffle; labels, language, source and id are no
inputs of a score.

Defined results: a null, empty or blank text is one empty line. Without labels of both kinds
every score is 0.5. A null id is not held out. A document with several labels counts as bad if
one of them is 0. Repeated rows are scored one by one; other columns are ignored.
"""

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOLD_OUT = 3
HELD_REMAINDER = 1
TRAIN_DOCS = 3000
TRAIN_CHARS = 20_000
# Padded blocks hold about so many lines at most.
BLOCK_LINES = 160_000
ROUNDS = 250
RATE = 0.08
RIDGE = 1e-3
SYMBOLS = b"#*$%&|<>"
MEASURES = 17


def _classes() -> np.ndarray:
    table = np.zeros((256, 6), dtype=np.float64)
    for byte in range(256):
        char = bytes([byte])
        table[byte] = [
            char in SYMBOLS, char.isdigit(), char.isupper(), char in b"!?", char in b",;:",
            char in b".",
        ]
    return table


CLASSES = _classes()


def measures(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of measures, one a line with its neighbours', and the lines' lengths."""
    lines = [
        line for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n") if line.strip()
    ] or [b""]
    sizes = np.array([len(line) for line in lines])
    codes = np.frombuffer(b"\n".join(lines) + b"\n", dtype=np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    counts = np.stack([np.add.reduceat(CLASSES[codes, k], starts) for k in range(CLASSES.shape[1])], 1)
    shares = counts / np.maximum(sizes, 1)[:, None]
    own = np.empty((len(lines), MEASURES))
    seen: set[bytes] = set()
    before = b""
    for k, line in enumerate(lines):
        words = line.split()
        n = max(len(words), 1)
        own[k, :11] = (
            math.log1p(len(line)), math.log1p(len(words)), len(line) / n, len(set(words)) / n,
            sum(map(eq, words, words[1:])) / n, line.count(b"|") / n, line in seen,
            line == before, line[-1:] in b".!?" and bool(line), line[:1].isupper(),
            sum(map((3).__ge__, map(len, words))) / n,
        )
        seen.add(line)
        before = line
    own[:, 11:] = shares
    edge = np.zeros((1, MEASURES))
    return np.hstack([own, np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge])]), sizes


@dataclass
class LineField:
    """Emission weights over standardised measures, transitions [from, to], calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def evidence(self, rows: np.ndarray) -> np.ndarray:
        scaled = np.clip((rows - self.mean) / self.scale, -5, 5)
        return scaled @ self.weights[:-1] + self.weights[-1]

    def quality(self, text: str | None) -> float:
        """Length-weighted mean marginal of good lines."""
        rows, sizes = measures(text)
        odds = _marginal_odds(self.evidence(rows)[None, :], np.ones((1, len(rows))), self.moves)[0]
        weight = sizes + 1.0
        return float((weight / (1 + np.exp(-np.clip(odds[0], -50, 50)))).sum() / weight.sum())

    def score(self, text: str | None) -> float:
        mean = min(max(self.quality(text), 1e-6), 1 - 1e-6)
        return 1 / (1 + math.exp(-(self.slope * math.log(mean / (1 - mean)) + self.shift)))


def _marginal_odds(evidence: np.ndarray, mask: np.ndarray, moves: np.ndarray
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward in log odds, over padded sequences: marginals, forward, backward."""
    n, steps = evidence.shape
    forward, backward = np.zeros((n, steps)), np.zeros((n, steps))
    (bb, bg), (gb, gg) = moves
    forward[:, 0] = evidence[:, 0]
    for t in range(1, steps):
        a = forward[:, t - 1]
        forward[:, t] = evidence[:, t] + np.logaddexp(a + gg, bg) - np.logaddexp(a + gb, bb)
    for t in range(steps - 2, -1, -1):
        b = evidence[:, t + 1] + backward[:, t + 1]
        step = np.logaddexp(b + gg, gb) - np.logaddexp(b + bg, bb)
        backward[:, t] = step * mask[:, t + 1]
    return forward + backward, forward, backward


def _gradient(field: LineField, scaled: np.ndarray, mask: np.ndarray, good: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
    """Of the mean log likelihood, by emission weights and moves."""
    evidence = (scaled @ field.weights[:-1] + field.weights[-1]) * mask
    odds, forward, backward = _marginal_odds(evidence, mask, field.moves)
    missed = (good - 1 / (1 + np.exp(-np.clip(odds, -50, 50)))) * mask
    total = mask.sum()
    weights = np.append(np.einsum("ns,nsf->f", missed, scaled), missed.sum()) / total
    a, b = forward[:, :-1], (evidence + backward)[:, 1:]
    logs = np.stack([
        np.full_like(a, field.moves[0, 0]), field.moves[0, 1] + b,
        field.moves[1, 0] + a, field.moves[1, 1] + a + b,
    ])
    logs -= logs.max(axis=0)
    pair = np.exp(logs)
    pair /= pair.sum(axis=0)
    both = mask[:, 1:]
    state = (2 * good[:, :-1] + good[:, 1:]).astype(int)
    moves = [((state == k) - pair[k]) * both for k in range(4)]
    return weights, np.array([m.sum() for m in moves]).reshape(2, 2) / total


def _spliced(texts: list[str], labels: list[int]) -> list[list[tuple[str, int]]]:
    """Lines with labels: every document, and splices of neighbours of different quality."""
    split = [[(line, label) for line in text.split("\n") if line.strip()]
             for text, label in zip(texts, labels)]
    split = [lines for lines in split if lines]
    good = [lines for lines in split if lines[0][1]]
    bad = [lines for lines in split if not lines[0][1]]
    mixed = []
    for k, lines in enumerate(bad):
        other = good[k % len(good)] if good else []
        cut = len(other) // 2
        mixed.append(other[:cut] + lines + other[cut:])
    return split + mixed


def fitted(texts: list[str], labels: list[int]) -> LineField | None:
    """Trained by Adam on the regularised likelihood; None unless both labels occur."""
    if len(set(labels)) < 2:
        return None
    sequences = _spliced(texts, labels)
    if len({label for lines in sequences for _, label in lines}) < 2:
        return None
    rows = [measures("\n".join(line for line, _ in lines))[0] for lines in sequences]
    every = np.concatenate(rows)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    field = LineField(mean, scale, np.zeros(every.shape[1] + 1), np.zeros((2, 2)))
    # Sequences of like length share a padded block.
    order = sorted(range(len(rows)), key=lambda k: len(rows[k]))
    blocks = []
    parts = []
    for part in np.array_split(np.array(order), max(1, len(order) // 400)):
        cells = len(part) * len(rows[part[-1]])
        parts += np.array_split(part, min(len(part), -(-cells // BLOCK_LINES)))
    for part in parts:
        steps = max(len(rows[k]) for k in part)
        scaled = np.zeros((len(part), steps, every.shape[1]))
        mask, good = np.zeros((len(part), steps)), np.zeros((len(part), steps))
        for at, k in enumerate(part):
            n = len(rows[k])
            scaled[at, :n] = np.clip((rows[k] - mean) / scale, -5, 5)
            mask[at, :n] = 1
            good[at, :n] = [label for _, label in sequences[k]]
        blocks.append((scaled, mask, good))
    size = sum(block[1].sum() for block in blocks)
    first = np.zeros(len(field.weights) + 4)
    second = np.zeros_like(first)
    for k in range(1, ROUNDS + 1):
        slope = np.zeros_like(first)
        for block in blocks:
            weights, moves = _gradient(field, *block)
            slope += np.append(weights, moves.ravel()) * block[1].sum() / size
        slope[:-4] -= RIDGE * field.weights
        slope[-4:] -= RIDGE * field.moves.ravel()
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        step = RATE * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
        field.weights = field.weights + step[:-4]
        field.moves = field.moves + step[-4:].reshape(2, 2)
    return _calibrated(field, texts, labels)


def _calibrated(field: LineField, texts: list[str], labels: list[int]) -> LineField:
    """Logistic fit of the labels to the log odds of the mean marginal."""
    mean = np.clip([field.quality(text) for text in texts], 1e-6, 1 - 1e-6)
    x, y = np.log(mean / (1 - mean)), np.array(labels, dtype=float)
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -30, 30)))
        h = p * (1 - p) + 1e-9
        grad = np.array([((y - p) * x).sum() - 0.01 * slope, (y - p).sum() - 0.01 * shift])
        curve = np.array([[(h * x * x).sum() + 0.01, (h * x).sum()],
                          [(h * x).sum(), h.sum() + 0.01]])
        step = np.clip(np.linalg.solve(curve, grad), -2, 2)
        slope, shift = max(slope + step[0], 0.05), shift + step[1]
    field.slope, field.shift = float(slope), float(shift)
    return field


def held_out(id_column: Column) -> Column:
    check = F.crc32(F.coalesce(id_column.cast("string"), F.lit("")))
    return id_column.isNotNull() & (check % HOLD_OUT == HELD_REMAINDER)


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS
                  ) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``limit`` documents that are not held out."""
    marked = labels.where("doc_id is not null and quality is not null").where(
        ~held_out(F.col("doc_id"))
    ).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    usable = docs.where(
        F.col("text").isNotNull() & (F.char_length("text") <= TRAIN_CHARS)
    ).select("doc_id", "text")
    # Ids of usable texts alone are ranked; at most ``limit`` are picked, whatever the tables' size.
    picked = marked.join(usable.select("doc_id").distinct(), "doc_id").orderBy(
        F.xxhash64("doc_id"), "doc_id"
    ).limit(limit)
    met = usable.join(F.broadcast(picked), "doc_id")
    found = {}
    for row in met.groupBy("doc_id", "quality").agg(F.min("text").alias("text")).collect():
        found[row["doc_id"]] = (row["text"], int(row["quality"] == 1))
    chosen = [found[key] for key in sorted(found, key=lambda k: hashlib.md5(str(k).encode()).digest())]
    return [text for text, _ in chosen], [label for _, label in chosen]


def scored(docs: DataFrame, field: LineField | None, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """``id, score`` of every row."""
    read = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [field.score(text.as_py()) if field else 0.5 for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(scores, pa.float64())], names=["id", "score"]
            )

    return read.mapInArrow(taken, f"id {read.schema['id'].dataType.simpleString()}, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    found = scored(docs, fitted(*training_rows(docs, labels)))
    return found.select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
