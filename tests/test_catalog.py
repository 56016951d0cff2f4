"""Every named query against its SQL on the smallest test tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from pulsegrid import catalog
from tools.check import compare

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_sql(spark, tables, name):
    outcome, _ = compare(spark, tables, name, SF)
    assert outcome.startswith("ok"), outcome


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["age_band", "avg_risk", "count"] and df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLES) <= set(entry.oracle_sql())


def test_no_cartesian_products(spark):
    for name in ("overview", "top_conditions", "daily_report", "running_totals", "risk_change", "patched_profiles"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_latest_readings_are_limited_before_the_shuffle(spark):
    for name in ("latest_readings", "dedup_readings", "abnormal_patients"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        limit = plan.index("Partial", plan.rindex("WindowGroupLimit"))
        assert plan.rindex("Exchange hashpartitioning(", 0, limit) < limit, name


def test_unused_orders_are_not_read(spark):
    plan = entry.queries()["risk_by_age"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan


def test_the_other_queries_stay_without_the_corpus_packages(monkeypatch):
    import importlib

    def missing(name, *_):
        raise ModuleNotFoundError(f"No module named {name!r}")

    monkeypatch.setattr(importlib, "import_module", missing)
    assert set(entry.queries()) == set(catalog.QUERIES) and set(entry.oracle_sql()) == set(catalog.ORACLES)
