"""What the physical plans of the queries may not hold."""

import pytest

import __spark_entry__ as driver
from places import TESTDATA
from ringledger.checks.queries import QUERIES as OWN
from ringledger.plans.feeds import normalise_itemized
from ringledger.schemas import ITEMIZED_CSV
from ringledger.sources.files import read_itemized_csv

QUERIES = {name: driver.queries()[name] for name in OWN}

# Every pair of rows, a row through Python, or all rows in one task.
FORBIDDEN = [
    "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
    "MapInPandas", "MapInArrow", "FlatMapGroups",
]

# Results of a row per table, the peak of all hours, the first n rows, and the sizes of
# partitions being added up: a row per partition or fewer meet in one task.
SINGLE_TASK = {
    "max_billing_year", "max_billing_month_in_year", "high_watermark_period", "peak_hour",
    "limited_copy", "batch_numbering",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(name, spark):
    result = QUERIES[name](spark, str(TESTDATA / "sf0.001"))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
    assert ("Exchange SinglePartition" in plan) <= (name in SINGLE_TASK)


def test_filters_and_columns_reach_the_scan(spark):
    result = QUERIES["limited_copy"](spark, str(TESTDATA / "sf0.01"))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(o_orderkey,499)" in plan
    schema = "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderpriority:string>"
    assert schema in plan


@pytest.fixture
def planned_at_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def _largest_method(df):
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    return max((stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())), default=0)


# The JVM interprets methods above 8000 bytes, which makes a query many times slower.
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_method_is_compiled(name, spark, planned_at_once):
    assert _largest_method(QUERIES[name](spark, str(TESTDATA / "sf0.001"))) < 8000


def test_the_widest_feed_stays_compiled(spark, planned_at_once, tmp_path):
    (tmp_path / "201805_a.csv").write_text(",".join(ITEMIZED_CSV.names) + "\n")
    assert 0 < _largest_method(normalise_itemized(read_itemized_csv(spark, str(tmp_path)))) < 8000
