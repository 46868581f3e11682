import itertools
import zlib

import numpy as np
import pytest

from ringledger.llm import line_crf as crf

LABELS = "doc_id long, quality int, toxic int"


def test_marginals_match_all_label_sequences():
    rng = np.random.default_rng(1)
    for steps in (1, 2, 5):
        evidence, moves = rng.normal(size=steps), rng.normal(size=(2, 2))
        weight = np.zeros((steps, 2))
        for labels in itertools.product([0, 1], repeat=steps):
            total = sum(evidence[k] * y for k, y in enumerate(labels))
            total += sum(moves[a, b] for a, b in zip(labels, labels[1:]))
            for k, y in enumerate(labels):
                weight[k, y] += np.exp(total)
        odds = crf._marginal_odds(evidence[None, :], np.ones((1, steps)), moves)[0][0]
        assert np.allclose(odds, np.log(weight[:, 1] / weight[:, 0]))


def test_gradient_matches_differences():
    rng = np.random.default_rng(2)
    n, f = 4, 3
    field = crf.LineField(np.zeros(f), np.ones(f), rng.normal(size=f + 1), rng.normal(size=(2, 2)))
    scaled, good = rng.normal(size=(1, n, f)), np.array([[1.0, 0, 0, 1]])
    mask = np.ones((1, n))

    def likelihood():
        evidence = scaled[0] @ field.weights[:-1] + field.weights[-1]
        def total(y):
            return sum(e * v for e, v in zip(evidence, y)) + sum(
                field.moves[int(a), int(b)] for a, b in zip(y, y[1:]))
        every = [total(y) for y in itertools.product([0, 1], repeat=n)]
        return (total(good[0]) - np.logaddexp.reduce(every)) / n

    weights, moves = crf._gradient(field, scaled, mask, good)
    for values, slope in ((field.weights, weights), (field.moves.reshape(-1), moves.ravel())):
        for k in range(len(values)):
            values[k] += 1e-5
            up = likelihood()
            values[k] -= 2e-5
            down = likelihood()
            values[k] += 1e-5
            assert slope[k] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = crf.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 500
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.97
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.98


def test_held_out_rows_are_never_learnt_from(spark, documents):
    docs = documents([(k, f"text {k}") for k in range(60)])
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)] + [(None, 1, 0), (7, None, 0)], LABELS)
    texts, _ = crf.training_rows(docs, labels)
    learnt = {int(text.split()[1]) for text in texts}
    assert learnt == {k for k in range(60) if zlib.crc32(str(k).encode()) % 3 != 1}
    assert len(crf.training_rows(docs, labels, limit=5)[0]) == 5


def test_odd_documents_and_names(spark, odd_documents, clashing):
    docs = clashing(odd_documents)
    none = crf.quality(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(none) == docs.count() and {r["score"] for r in none} == {0.5}
    field = crf.fitted(["fine words in a line.\nand more of them."] * 3, [1] * 3)
    assert field is None
    field = crf.fitted(["fine words in a line.\nand more of them.", "$$ || $$ ||\n## ## ##"] * 5, [1, 0] * 5)
    rows = crf.scored(docs, field).collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert field.score("fine words in a line.") > 0.5 > field.score("$$ || $$ ||")
    assert not any(r["held_out"] for r in none if r["doc_id"] is None)


def test_empty_table(spark, documents):
    assert crf.quality(documents([]), spark.createDataFrame([], LABELS)).collect() == []


def test_limit_counts_usable_texts_only(spark, documents):
    long = "word " * 5000
    docs = documents([(k, long if k % 2 else f"short text {k}") for k in range(200)] + [(300, None)])
    labels = spark.createDataFrame([(k, k % 3 % 2) for k in range(400)], "doc_id long, quality int")
    texts, _ = crf.training_rows(docs, labels, limit=30)
    assert len(texts) == 30 and all(text.startswith("short") for text in texts)


def test_training_texts_are_read_whole():
    text = "\n".join(f"line {k}" for k in range(900))
    lines = crf._spliced([text, "bad"], [1, 0])
    assert [len(x) for x in lines] == [900, 1, 901]
