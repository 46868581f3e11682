"""One query per text operator, with production parameters, over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.llm import (
    chat_format,
    decontamination,
    html_extraction,
    language_id,
    lexical_search,
    license_scan,
    line_crf,
    mixing,
    quality_rules,
    simhash,
    structure_repair,
    suffix_dedup,
    url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.perspectives(_table(spark, sf_dir, "conversations"))


LICENSE_PHRASES = (
    license_scan.Template("mit", "under the mit license", exact=True),
    license_scan.Template("apache-2", "apache license version 2", exact=True),
    license_scan.Template("cc-by-nc", "cc by nc", exact=True),
)
# The license's bare name is no base place, but tells the license all the same.
LICENSE_SENTENCES = (
    *license_scan.SENTENCES,
    license_scan.Template("mit", "mit license", exact=True, base=False),
)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_scan(
        _table(spark, sf_dir, "documents"), phrases=LICENSE_PHRASES, sentences=LICENSE_SENTENCES
    )
    return found.withColumnRenamed("id", "doc_id")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents")).select(
        "row.doc_id", "source", "language", "topic", "n_tokens",
        F.round("probability", 6).alias("probability"),
    )


URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(_table(spark, sf_dir, "pages"), URL_RULES).select(
        "row.page_id", "host", "path", "rule", "verdict"
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_rules.quality_rules(docs, _table(spark, sf_dir, "labels")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )


def op7_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    n_hit = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda acc, span: acc + span["last"] - span["first"] + 1
    )
    return found.select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extracted(_table(spark, sf_dir, "pages")).select(
        F.col("id").alias("page_id"), "url", "text",
        F.char_length("text").cast("long").alias("n_chars"),
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.removals(_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    third = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3
    counts = language_id.learned(docs.where(third != 1))
    key = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % 3
    return language_id.predicted(docs, counts).select(
        F.col("id").alias("doc_id"), (key == 1).alias("held_out"), "lang_pred", "score"
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = structure_repair.prepared(_table(spark, sf_dir, "conversations"))
    return structure_repair.repairs(structure_repair.damaged(rows)).withColumnRenamed(
        "conv", "conv_id"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_chat_format": op2_chat_format,
    "op3_license_scan": op3_license_scan,
    "op4_mixing": op4_mixing,
    "op5_url_filter": op5_url_filter,
    "op6_quality_rules": op6_quality_rules,
    "op7_line_crf": op7_line_crf,
    "op8_decontamination": op8_decontamination,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_html_extraction": op10_html_extraction,
    "op11_language_id": op11_language_id,
    "op12_lexical_search": op12_lexical_search,
    "op13_structure_repair": op13_structure_repair,
}

ORACLE: dict[str, str] = {
    "op2_chat_format": chat_format.ORACLE,
    "op3_license_scan": license_scan.oracle(),
    "op4_mixing": mixing.oracle(),
    "op5_url_filter": url_filter.oracle(URL_RULES),
    "op12_lexical_search": lexical_search.ORACLE,
}
