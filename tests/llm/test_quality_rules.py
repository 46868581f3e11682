import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ringledger.llm import quality_rules as rules

LABELS = "doc_id long, quality int, toxic int"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    count, covered = Counter(windows), set()
    for k, window in enumerate(windows):
        if count[window] > 1:
            covered.update(range(k, k + 5))
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered)]


def _judged(docs, labels):
    return rules.quality_rules(docs, labels).select("row.*", *BASE, "score", "base_failed", F.col("kept").alias("stays")).collect()


def test_base_statistics_match_brute_force(odd_documents, clashing, spark):
    more = odd_documents.union(spark.createDataFrame([
        (50, "a b c d e f a b c d e f\nx\nx\n\n x\n# $5 <b>|\n\r\n", "en", "a", 1),
        (51, "a b c d e a b c d e", "en", "a", 1), (52, "x " * 12, "en", "a", 1),
    ], odd_documents.schema))
    for row in _judged(more, spark.createDataFrame([], LABELS)):
        expected = _base(row["text"])
        assert [row[name] for name in BASE] == expected
        failed = expected[0] < 10 or 100 * expected[4] > 20 * expected[0]
        assert row["base_failed"] == failed and row["stays"] == (not failed) and row["score"] == 0
    names = clashing(more)
    assert rules.quality_rules(names, spark.createDataFrame([], LABELS)).select("row.*").columns == names.columns


def test_ratio_is_the_mean_log_ratio_of_both_multinomials(documents, spark):
    texts = {1: "good plain words in a row here we go now", 2: "zz$$ | yy$$ | xx$$ | ww$$ | vv$$ | uu$$"}
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 0), (None, 1, 0), (9, None, 0)], LABELS)
    buckets = 64
    docs = documents(list(texts.items()))
    found = {r["doc_id"]: r["score"] for r in
             rules.quality_rules(docs, labels, buckets).select("row.doc_id", "score").collect()}

    def grams(text):
        words = text.split()
        rows = [(w, None, None) for w in words]
        rows += [(None, a, b) for a, b in zip(words, words[1:])]
        hashed = spark.createDataFrame(rows, "w string, a string, b string").select(F.pmod(
            F.when(F.col("w").isNotNull(), F.xxhash64("w")).otherwise(F.xxhash64(F.lit("pair"), "a", "b")),
            F.lit(buckets)))
        return [r[0] for r in hashed.collect()]

    all_grams = {name: grams(text) for name, text in texts.items()}
    raw = Counter(g for gs in all_grams.values() for g in gs)
    target = Counter(all_grams[1])
    n_raw, n_target = sum(raw.values()) + buckets, sum(target.values())
    for name, gs in all_grams.items():
        logs = [math.log((target[g] + buckets * (raw[g] + 1) / n_raw) / (n_target + buckets)
                         / ((raw[g] + 1) / n_raw)) for g in gs]
        assert found[name] == pytest.approx(sum(logs) / len(logs), abs=1e-9)
    assert found[1] > 0 > found[2]


def test_threshold_decides_every_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = _judged(docs, labels)
    assert len(rows) == docs.count()
    assert all(r["stays"] == (not r["base_failed"] and r["score"] >= rules.MIN_RATIO) for r in rows)


def test_filtering_on_the_verdict_is_no_slower_plan(spark, documents):
    docs = documents([(k, "some words that are long enough to be kept in here ok") for k in range(5)])
    kept = rules.quality_rules(docs, spark.createDataFrame([], LABELS)).where("kept").select("row.*")
    assert kept.count() == 5


def test_texts_are_shuffled_only_beyond_the_counted_limit(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")

    def told():
        found = rules.trusted_texts(docs, labels)
        return found._jdf.queryExecution().executedPlan().toString(), sorted(found.collect(), key=str)

    plan, rows = told()
    assert "BroadcastHashJoin" in plan and "ShuffledHashJoin" not in plan
    monkeypatch.setattr(rules, "BROADCAST_IDS", 0)
    plan, shuffled = told()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan and rows == shuffled


def test_bucket_count_is_bounded(documents, spark):
    for buckets in (0, rules.MOST_BUCKETS + 1):
        with pytest.raises(ValueError):
            rules.quality_rules(documents([(1, "a")]), spark.createDataFrame([], LABELS), buckets)


def test_query_on_whole_table(spark):
    from ringledger.llm.queries import QUERIES

    found = QUERIES["op6_quality_rules"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert sorted((r["doc_id"], *[r[name] for name in BASE]) for r in found) == sorted(
        (r["doc_id"], *_base(r["text"])) for r in docs)
    quality = {r["doc_id"]: r["quality"] for r in
               spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    good = [r["kept"] for r in found if quality.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert sum(good) / len(good) > 0.99


def test_empty_table(documents, spark):
    assert _judged(documents([]), spark.createDataFrame([], LABELS)) == []
