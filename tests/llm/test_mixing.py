import pytest
from pyspark.sql import functions as F

from ringledger.llm import mixing

CELLS = "source string, language string, topic string, tokens double"


def _cells(spark):
    return spark.createDataFrame([
        (s, g, t, float(1 + 7 * i + 3 * j + 11 * k)) for i, s in enumerate("abc")
        for j, g in enumerate(["de", "en"]) for k, t in enumerate(["x", "y"])
    ], CELLS)


def test_marginals_reach_their_targets(spark):
    raked = mixing.raked(_cells(spark)).collect()
    total = sum(r["weight"] for r in raked)
    assert total == pytest.approx(1)
    for name in mixing.DIMENSIONS:
        sums = {}
        for r in raked:
            sums.setdefault(r[name], [0.0, r[f"{name}_target"]])[0] += r["weight"]
        assert all(reached == pytest.approx(wanted, abs=1e-8) for reached, wanted in sums.values())
        assert sum(wanted for _, wanted in sums.values()) == pytest.approx(1)


def test_given_targets(spark):
    wanted = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 2.0)], "source string, target double")
    raked = mixing.raked(_cells(spark), targets={"source": wanted}).collect()
    assert sum(r["weight"] for r in raked if r["source"] == "a") == pytest.approx(0.5)


def test_sample_follows_the_probabilities(spark, documents):
    docs = documents([
        (k, "some words here " * (1 + k % 5), "en" if k % 3 else "fr", "hot" if k % 3 else f"s{k % 4}", 1)
        for k in range(3000)
    ])
    rows = mixing.mixed(docs).select("row.doc_id", "source", "probability").collect()
    expected = {}
    for r in rows:
        expected.setdefault(r["source"], []).append(r["probability"])
    assert max(r["probability"] for r in rows) == pytest.approx(1)
    counts = {r["source"]: r["n"] for r in docs.groupBy("source").agg(F.count("*").alias("n")).collect()}
    for source, drawn in expected.items():
        assert len(drawn) == pytest.approx(counts[source] * drawn[0], rel=0.15)
    assert sorted(r["doc_id"] for r in rows) == sorted(
        r["doc_id"] for r in mixing.mixed(docs).select("row.doc_id").collect())


def test_odd_documents_and_names(odd_documents, clashing):
    docs = clashing(odd_documents)
    drawn = mixing.mixed(docs).select("row.*")
    assert drawn.columns == docs.columns
    ids = [r["doc_id"] for r in drawn.collect()]
    # Rows of one id are drawn together.
    assert ids.count(3) in (0, 3)


def test_empty_and_wordless_tables(documents):
    assert mixing.mixed(documents([])).collect() == []
    assert mixing.mixed(documents([(1, ""), (2, None)])).collect() == []
