"""SimHash near copies through a segment-popcount grid.

A fingerprint's 64 bits are cut into 32 segments of two bits. Mapping each segment to its
number of set bits embeds the fingerprint in a 32-dimensional grid in which Manhattan distance
never exceeds the number of differing bits. Two points at Manhattan distance ``d`` or less
agree exactly in at least two of ``d + 2`` blocks of dimensions, so the range join becomes an
equality join on the grid cells of every pair of blocks. Pairs from one cell are kept if the
Manhattan distance and then the true bit distance are small enough; both are bit operations,
since counts in unary code differ in as many bits as their distance.

Exact copies fall together before the join. A fingerprint has at most 2080 others within two
bits of it, so links stay bounded however large a group of copies is.

Defined results: null, empty and blank texts have fingerprint zero and are linked to each
other like any other; texts shorter than a shingle are one shingle; long texts are hashed whole,
block by block. Repeated rows give repeated results. A null id is carried along and never names a
component, unless the component has no other. An empty table gives an empty result. Other columns
are not read, whatever their names.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.components import components
from ringledger.llm.frames import packed, unpacked
from ringledger.llm.grid import unary_counts
from ringledger.llm.shingles import shingle_hashes
from ringledger.operators.staging import staged

SHINGLE = 3
MAX_BITS = 2
SEGMENTS = 32


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint; a bit is set if it is in over half the shingle hashes."""
    counts, n = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(text, shingle):
        octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    bits = np.packbits(counts * 2 > n).tobytes()
    return int.from_bytes(bits, "big", signed=True)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``id, fp`` of every row."""
    read = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py(), shingle) for text in batch.column("text")]
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "fp": pa.array(prints, pa.int64())}
            )

    return read.mapInArrow(taken, f"id {read.schema['id'].dataType.simpleString()}, fp long")


def _block_masks(blocks: int) -> list[int]:
    cuts = [2 * (SEGMENTS * k // blocks) for k in range(blocks + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b`` (a < b) for distinct fingerprints ``fp`` that differ in ``max_bits`` or fewer."""
    masks = [_signed(x | y) for x, y in combinations(_block_masks(max_bits + 2), 2)]
    points = classes.select("fp", unary_counts(F.col("fp")).alias("counts"))
    cells = points.select("fp", "counts", F.posexplode(F.array(*[
        F.col("counts").bitwiseAND(F.lit(mask)) for mask in masks
    ])).alias("grid", "cell"))
    one, other = cells.alias("one"), cells.alias("other")

    def apart(name: str) -> Column:
        return F.bit_count(F.col(f"one.{name}").bitwiseXOR(F.col(f"other.{name}")))

    near = one.join(other, (
        (F.col("one.grid") == F.col("other.grid")) & (F.col("one.cell") == F.col("other.cell"))
        & (F.col("one.fp") < F.col("other.fp"))
        & (apart("counts") <= max_bits) & (apart("fp") <= max_bits)
    ))
    return near.select(F.col("one.fp").alias("a"), F.col("other.fp").alias("b"))


def near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``id, fp, component_id`` per row: the smallest id reachable over links, its own included."""
    prints = staged(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    classes = staged(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "classes")
    labels = components(links(classes, max_bits))
    # Fingerprints without a link are components of their own.
    grouped = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label")
    )
    first = grouped.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = staged(grouped.join(first, "label").select("fp", "component_id"), "components")
    return prints.join(named, "fp").select("id", "fp", "component_id")


def as_hex(fp: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` whose id names its component; the others are near copies of it.

    Rows without an id can't be named and stay. Fully equal rows collapse to one.
    """
    found = near_copies(docs, id_column, text_column, shingle, max_bits)
    # An id that stands on rows of several groups goes only if it names none of them.
    copies = found.where("id is not null").groupBy(F.col("id").alias("copy_id")).agg(
        F.bool_or(F.col("id") == F.col("component_id")).alias("names")
    ).where("not names").select("copy_id")
    named = packed(docs, named=F.col(f"`{id_column}`"))
    kept = named.join(copies, F.col("named") == F.col("copy_id"), "left_anti")
    return unpacked(kept).dropDuplicates()
