"""Every query gives what its SQL twin gives on an independent engine."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from places import TESTDATA
from ringledger.checks.oracle import ORACLE
from ringledger.checks.queries import QUERIES as OWN

QUERIES = {name: driver.queries()[name] for name in OWN}

SF = TESTDATA / "sf0.01"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _value(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_twin(name, spark, oracle):
    found = QUERIES[name](spark, str(SF))
    wanted = oracle.execute(ORACLE[name])
    columns = [column[0] for column in wanted.description]
    expected = wanted.fetchall()
    assert sorted(found.columns) == sorted(columns)
    rows = found.collect()
    assert len(rows) == len(expected)
    assert expected, "an empty result proves nothing"
    got, want = _bag(found.columns, rows), _bag(columns, expected)
    assert not (got - want), list((got - want).items())[:3] + list((want - got).items())[:3]
