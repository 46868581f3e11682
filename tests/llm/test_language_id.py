import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ringledger.llm import language_id, queries

ORDER = language_id.ORDER


def _counts(texts, order=ORDER):
    grams = Counter()
    for text in texts:
        data = b"\n" * order + text
        grams.update(int.from_bytes(data[k : k + order + 1], "big") for k in range(len(text)))
    return np.array(list(grams), dtype=np.uint64), np.array(list(grams.values()), dtype=np.int64)


def _length(texts, context, byte):
    """By the book: from the longest known context down, excluding what was seen before."""
    seen = defaultdict(Counter)
    for text in texts:
        data = b"\n" * ORDER + text
        for k in range(ORDER, len(data)):
            for j in range(ORDER + 1):
                seen[data[k - j : k]][data[k]] += 1
    bits, excluded = 0.0, set()
    for j in range(ORDER, -1, -1):
        counts = {b: n for b, n in seen[context[ORDER - j :]].items() if b not in excluded}
        if not counts:
            continue
        total = sum(counts.values()) + len(counts)
        if byte in counts:
            return bits + math.log2(total / counts[byte])
        bits += math.log2(total / len(counts))
        excluded |= set(counts)
    return bits + math.log2(256 - len(excluded))


TEXTS = [b"abracadabra", b"abba", b"cabbage and cab", b"\x00\xff\n\n\n\n\nab"]


def test_lengths_against_the_definition():
    tree = language_id.Tree(*_counts(TEXTS))
    chosen = random.Random(1)
    for _ in range(400):
        context = bytes(chosen.choices(b"abcdr \n\x00\xff", k=ORDER))
        byte = chosen.choice(b"abcdrgx\n\xff")
        gram = np.array([int.from_bytes(context + bytes([byte]), "big")], dtype=np.uint64)
        assert tree.lengths(gram)[0] == pytest.approx(_length(TEXTS, context, byte), abs=1e-9)


@pytest.mark.parametrize("context", [b"abra", b"\n\n\n\n", b"zzzz", b"zabb", b"\x00\xff\n\n"])
def test_a_whole_distribution(context):
    tree = language_id.Tree(*_counts(TEXTS))
    base = int.from_bytes(context, "big") << 8
    lengths = tree.lengths(np.array([base + b for b in range(256)], dtype=np.uint64))
    assert np.exp2(-lengths).sum() == pytest.approx(1)


def test_totals_of_pieces_equal_the_sum_of_bytes(monkeypatch):
    monkeypatch.setattr(language_id, "PIECE", 16)
    model = language_id.Model({"x": _counts(TEXTS[:2]), "y": _counts(TEXTS[2:])})
    texts = [b"", b"a", b"cab and abra " * 9, b"\xffq" * 40, b"abracadabra"]
    wanted = []
    for text in texts:
        data = b"\n" * ORDER + text
        grams = language_id.windows(np.frombuffer(data, np.uint8))
        wanted.append([
            int(np.rint(tree.lengths(grams) * language_id.UNIT).sum()) for tree in model.trees
        ])
    assert model.totals(texts).tolist() == wanted


def test_an_empty_tree_costs_eight_bits():
    tree = language_id.Tree(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert tree.lengths(np.array([5, 1 << 33], dtype=np.uint64)).tolist() == [8, 8]


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = queries.QUERIES["op11_language_id"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(docs)
    right = held = 0
    for row in found:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1
        if row["held_out"]:
            held += 1
            right += row["lang_pred"] == docs[row["doc_id"]]["lang"]
    assert held > 250 and right / held > 0.97


def test_odd_texts_and_empty_tables(documents, odd_documents, clashing):
    counts = language_id.learned(clashing(odd_documents))
    assert sorted(counts) == ["en"]
    rows = language_id.predicted(clashing(odd_documents), counts).collect()
    assert len(rows) == odd_documents.count()
    told = {(r["id"], r["lang_pred"]) for r in rows}
    assert {(0, "und"), (1, "und"), (2, "und"), (3, "en"), (7, "en"), (None, "en")} <= told
    assert all(r["score"] == (0 if r["lang_pred"] == "und" else 1) for r in rows)
    numbers = documents([(1, "123 ... ²"), (2, "é"), (3, None)])
    found = {r["id"]: r["lang_pred"] for r in language_id.predicted(numbers, counts).collect()}
    assert found == {1: "und", 2: "en", 3: "und"}
    nothing = language_id.learned(documents([]))
    assert nothing == {}
    assert {r["lang_pred"] for r in language_id.predicted(odd_documents, nothing).collect()} == {"und"}
    assert language_id.predicted(documents([]), counts).collect() == []


def test_ties_go_to_the_first_name(spark):
    model = language_id.Model({"b": _counts([b"same"]), "a": _counts([b"same"])})
    assert model.predicted([b"same text"]) == [("a", 0.5)]


def test_long_texts_are_learned_where_there_are_no_others(spark):
    rows = [("x", "long text " * 50), ("y", "brief"), ("y", "long text " * 50), (None, "a"), ("z", None)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    counts = language_id.learned(docs, train_docs=1, train_bytes=20)
    assert sorted(counts) == ["x", "y"]
    assert counts["y"][1].sum() == 5 and counts["x"][1].sum() == 500
