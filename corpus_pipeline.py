"""Documents through the text operators, stage by stage.

Every stage reads what its predecessor kept from Parquet and returns rows with the columns of
``documents``; the last one adds what it sampled by. Texts that a stage cuts have their
``n_chars`` counted anew; a document that a cut leaves without a word goes.

Every stage takes nulls in any column, empty, blank and very long texts, repeated rows, tied
values, an empty table and further columns of any name, which it hands on. Null and blank texts
fail the quality rules (no ten words), are copies of each other for the near-duplicate stage
(those without an id stay) and pass the two cutting stages untouched; they weigh nothing, so
mixing leaves them out. Repeated rows count as so many documents, but the near-duplicate stage
keeps one of them. An empty table stays empty.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.llm import decontamination as leaks
from ringledger.llm import mixing as mix
from ringledger.llm import quality_rules as rules
from ringledger.llm import simhash as copies
from ringledger.llm import suffix_dedup as repeats
from ringledger.llm.frames import BLANKS
from ringledger.operators.staging import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return rules.quality_rules(docs, labels).where("kept").select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return copies.one_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand earlier in the corpus."""
    return _recounted(docs, repeats.without_repeats)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _recounted(docs, lambda told: leaks.decontaminated(told, benchmark))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the target shares, and each document's probability behind its columns."""
    name = _free("probability", docs)
    return mix.mixed(docs).select("row.*", F.col("probability").alias(name))


def _free(name: str, docs: DataFrame) -> str:
    """``name``, with underscores behind it while ``docs`` has such a column."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _recounted(docs: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``docs`` after ``cut``, without those that had a word before and have none now."""

    def worded() -> Column:
        return F.coalesce(F.btrim("text", F.lit(BLANKS)) != "", F.lit(False))

    had = _free("had_words", docs)
    left = cut(docs.withColumn(had, worded())).where(worded() | ~F.col(had)).drop(had)
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mixing", source_mixing),
]

# The likelihood ratio, the fingerprints and the suffix merge have no SQL form; tests hold the
# stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are left after all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
