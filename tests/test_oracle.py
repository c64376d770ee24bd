"""Every query with an SQL form against DuckDB, and the published counts of the fixtures."""

import __spark_entry__ as driver
import parity
import pytest
from tallybook import catalog

ORACLE = driver.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return parity.connect(data)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, data, con, name):
    assert parity.differences(driver.queries()[name](spark, data), con, ORACLE[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).columns[0] == "year"


def test_known_counts(spark, data):
    w = catalog.workspace(spark, data)
    summary = catalog.QUERIES["dq_summary"](w).first()
    assert summary["valid_records"] == 60405
    assert [summary[i] for i in range(5, 10)] == [92, 35, 219, 336, 89]
    assert w.line_count == 59239
    assert w.features.count() == 701


def test_invariants(spark, data):
    w = catalog.workspace(spark, data)
    assert {r["violations"] for r in catalog.QUERIES["constraint_audit"](w).collect()} == {0}
    facts = w.fact_sales.selectExpr("count(*)", "min(sales_key)", "max(sales_key)", "sum(total_amount)").first()
    assert (facts[0], facts[1], facts[2]) == (59239, 1, 59239)
    assert w.mart_sales_performance.selectExpr("sum(total_revenue)").first()[0] == facts[3]
    firsts = w.fact_customer_retention.filter("order_sequence = 1")
    assert firsts.count() == firsts.select("customer_key").distinct().count()
    scores = w.mart_customer_rfm.selectExpr(
        "min(least(r_score, f_score, m_score))", "max(greatest(r_score, f_score, m_score))").first()
    assert tuple(scores) == (1, 5)
