import random
import re

import numpy as np
import pytest

from ringledger.llm import decontamination as dc
from ringledger.llm.fm_index import FMIndex

ITEMS = "item_id long, text string"
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _expected(docs, items):
    owners = {}
    for name, text in items:
        words = _words(text)
        for k in range(max(1, len(words) - 9) if words else 0):
            owners.setdefault(tuple(words[k : k + 10]), set()).update([] if name is None else [str(name)])
    out = []
    for name, text in docs:
        words, hit, found = _words(text), set(), set()
        for n in {len(w) for w in owners}:
            for k in range(len(words) - n + 1):
                if (window := tuple(words[k : k + n])) in owners:
                    hit.update(range(k, k + n))
                    found |= owners[window]
        out.append((name, len(words), len(hit), sorted(found)))
    return sorted(out, key=str)


def _found(docs, items, **options):
    rows = dc.contamination(docs, items, **options).collect()
    return sorted([(r["id"], r["n_words"], sum(s["last"] - s["first"] + 1 for s in r["spans"]),
                    list(r["items"])) for r in rows], key=str)


def test_fm_index_counts_and_locates():
    rng = random.Random(3)
    for _ in range(60):
        symbols = np.array([rng.choice([0, 1, 2, 3, 9]) for _ in range(rng.randint(1, 120))] + [0])
        index = FMIndex(symbols)
        for n in (1, 2, 5):
            phrases = np.array([[rng.choice([1, 2, 3, 9, 40]) for _ in range(n)] for _ in range(8)])
            low, high = index.ranges(phrases)
            for phrase, a, b in zip(phrases, low, high):
                places = [k for k in range(len(symbols)) if list(symbols[k : k + n]) == list(phrase)]
                assert sorted(index.locate(np.arange(a, b))) == places


@pytest.mark.parametrize("shard_words", [5, 1_000_000])
def test_against_brute_force(spark, documents, shard_words):
    rng = random.Random(5)
    vocabulary = ["Alpha", "beta", "gamma9", "día", "x", "über"]
    item = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(1, item(30)), (2, item(12)), (10, item(12)), (3, "beta x x beta"), (4, None), (5, "--"),
             (6, "x gamma9"), (7, "x gamma9"), (None, "über über alpha")]
    docs = [(k, "-".join([item(20), rng.choice(items)[1] or "", item(8)])) for k in range(30)]
    found = _found(documents(docs), spark.createDataFrame(items, ITEMS), shard_words=shard_words)
    assert found == _expected(docs, items)


def test_odd_documents_and_names(spark, odd_documents, clashing):
    items = [(1, "Word"), (2, "one two one two one two one two one two one")]
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert _found(clashing(odd_documents), spark.createDataFrame(items, ITEMS)) == _expected(docs, items)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], ITEMS)
    assert _found(documents([]), none) == []
    assert _found(documents([(1, "a b")]), none) == [(1, 2, 0, [])]


def test_cut_texts_hold_no_window(spark, documents, clashing):
    passage = "the quick brown fox jumps over the lazy dog again and again"
    docs = clashing(documents([(1, f"Before this, {passage.upper()}! After it."), (2, "clean text"), (3, None)]))
    items = spark.createDataFrame([(1, passage)], ITEMS)
    cleaned = dc.decontaminated(docs, items)
    assert cleaned.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert texts == {1: "Before this, \n! After it.", 2: "clean text", 3: None}
    assert all(row[2] == 0 for row in _found(cleaned, items))


def test_a_large_benchmark_is_refused(spark, documents):
    items = spark.createDataFrame([(1, "x" * 100)], ITEMS)
    with pytest.raises(ValueError, match="several parts"):
        dc.contamination(documents([]), items, max_benchmark_bytes=50)
