import re

import duckdb
import pytest

import corpus_pipeline
from ringledger.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "benchmark", "labels", "conversations"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    found = queries.QUERIES[name](spark, SF)
    names = sorted(found.columns)
    base = duckdb.connect()
    for table in TABLES:
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    wanted = base.execute(queries.ORACLE[name])
    columns = [column[0] for column in wanted.description]
    assert sorted(columns) == names
    expected = [tuple(dict(zip(columns, row))[n] for n in names) for row in wanted.fetchall()]
    assert sorted(map(tuple, found.select(*names).collect()), key=str) == sorted(expected, key=str)


def test_one_query_per_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_keeps_columns_and_takes_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.staged(stage(spark, docs, SF), f"stage-{k}")
        assert set(docs.columns) >= {"doc_id", "text", "lang", "source", "n_chars"}
        assert docs.where("n_chars <> char_length(text)").isEmpty()
        assert 0 < docs.count() <= before
        before = docs.count()
    assert docs.columns[-1] == "probability"
    assert corpus_pipeline.run(spark, SF).count() == before


def test_only_texts_emptied_by_a_cut_go(spark, documents):
    passage = " ".join(f"w{k * 7919 % 1009}" for k in range(60))
    rows = [(1, passage), (2, passage), (3, None), (4, " \n"), (5, "")]
    docs = documents(rows)
    left = corpus_pipeline.suffix_array_dedup(spark, docs, SF)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 3, 4, 5]


def test_mixing_stage_takes_a_column_of_its_own_name(spark, documents):
    docs = documents([(k, f"word {k} " * 30) for k in range(20)]).selectExpr("*", "'mine' as probability")
    left = corpus_pipeline.source_mixing(spark, docs, SF)
    assert left.columns == [*docs.columns, "probability_"]
    assert left.where("probability <> 'mine'").isEmpty()
