"""Every query against its SQL twin on the smallest tables, cell by cell, and its plan's shape."""

import importlib.util
import math
import re
from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

from oracle.statements import statements
from orderlens.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def load_entry():
    path = Path(__file__).resolve().parent.parent / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


ENTRY = load_entry()
QUERIES, STATEMENTS = catalog.queries(), statements()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (datetime, date)):
        return str(value)
    return value


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


# Windows over one row per month, or over a result of k rows.
SMALL_WINDOWS = {"revenue_by_country_top10", "revenue_sma", "revenue_forecast"}


def check_plan(name, df):
    """Shapes a plan must not have at scale."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert not re.search(r"Python|InPandas|InArrow", plan)
    if name not in SMALL_WINDOWS:
        # Global aggregates end in one task on partial results; a window there would get all rows.
        assert not re.search(r"Window .*\n.*Sort .*\n.*Exchange SinglePartition", plan)


def test_only_iterative_fits_and_sketches_have_no_twin():
    assert set(QUERIES) - set(STATEMENTS) == {
        "kmeans_elbow", "kmeans_segments", "kmeans_profiles",
        "monthly_customers_approx", "yearly_customers_approx", "price_quantiles_approx"}
    assert not set(STATEMENTS) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_its_twin(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    check_plan(name, df)
    found = table(df.columns, df.collect())
    relation = duck.sql(STATEMENTS[name])
    assert found == table(relation.columns, relation.fetchall())


def test_entry_runs(spark):
    assert ENTRY.entry(spark).count() == 8
