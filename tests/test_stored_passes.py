"""Queries of several passes read what they need from one stored table."""

import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlens.functions.distinct import distinct_counts
from orderlens.functions.durable import stored, stored_by
from orderlens.operators import cleaning, dashboard, features, kpi, pareto, star
from orderlens.plans import catalog
from orderlens.plans import inputs as plan_inputs
from orderlens.plans.inputs import Inputs
from orderlens.sources import retail

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "numeric_describe", "revenue_vs_orders", "clv_stats", "clv_hist", "order_size_stats", "order_size_hist",
    "price_stats", "price_hist", "amount_hist", "iqr_outliers"])
def test_passes_over_a_column_do_not_make_it_again(spark, name):
    assert "lineitem" not in plan_of(catalog.queries()[name](spark, FOLDER))


def test_lines_stored_by_customer_group_without_a_shuffle(spark):
    lines = stored_by(spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k long, v string"), "k")
    counts = lines.groupBy("k").agg(F.countDistinct("v").alias("n"))
    assert "Exchange" not in plan_of(counts)
    assert sorted(map(tuple, counts.collect())) == [(1, 2), (2, 1)]


def test_dashboard_lines_are_joined_once(spark, monkeypatch):
    inputs = Inputs(spark, FOLDER)
    made = []
    monkeypatch.setattr(cleaning, "customer_lines", lambda raw, of=cleaning.customer_lines: made.append(raw) or of(raw))
    inputs.customer_360
    assert len(made) == 1 and not {"sales", "fact", "features"} & set(inputs.__dict__)


def test_buyers_meet_orders_before_lines(spark):
    plan = retail.raw_lines(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    # Lines with parts, lines with orders, orders with buyers, buyers with nations.
    assert [next(k for k in ("pk#", "ok#", "ck#", "c_nationkey#") if k in j) for j in joins] == ["pk#", "ok#", "ck#", "c_nationkey#"]


def test_distinct_counts_of_lines_in_buckets_need_no_shuffle(spark):
    lines = stored_by(spark.createDataFrame([(1, "a", 5), (1, "b", 5), (2, "a", 6), (2, None, 6)], "k long, v string, w long"), "k")
    counts = distinct_counts(lines, "k", {"n": "v", "m": F.col("w") % 5}, in_buckets=True)
    assert "hashpartitioning" not in plan_of(counts)
    assert sorted(map(tuple, counts.collect())) == [(1, 2, 1), (2, 1, 1)]
    assert sorted(map(tuple, distinct_counts(lines, "k", {"n": "v", "m": F.col("w") % 5}).collect())) == [(1, 2, 1), (2, 1, 1)]


def test_dashboard_parts_read_bucketed_lines_without_copying_rows(spark, monkeypatch):
    plans = []
    for module, name in ((features, "durable"), (dashboard, "customer_360")):
        monkeypatch.setattr(module, name, lambda *dfs, of=getattr(module, name): plans.extend(map(plan_of, dfs)) or of(*dfs))
    Inputs(spark, FOLDER).customer_360
    assert len(plans) == 4 and not any("Expand" in p for p in plans)
    # The base of the features and the dimension; small joins may be broadcast.
    assert "hashpartitioning" not in plans[0] + plans[3]


def test_dashboard_lines_are_dealt_once_and_lose_their_copies_there(spark, monkeypatch):
    plans = []

    def kept(df, key, within=None):
        return stored_by(df, key, lambda rows: plans.append(plan_of(within(rows) if within else rows)) or (within(rows) if within else rows))

    monkeypatch.setattr(plan_inputs, "stored_by", kept)
    inputs = Inputs(spark, FOLDER)
    inputs.customer_360
    # Small tables are broadcast to the joins: the lines' only shuffle is the one by customer, without unknown ones.
    assert len(plans) == 1 and plans[0].count("hashpartitioning") == 1 and "hashpartitioning(CustomerID" in plans[0]
    before = plans[0][plans[0].index("hashpartitioning") :]
    assert "isnotnull" in before


def test_copies_are_removed_within_buckets(spark):
    rows = [(1, "a", 1.0), (1, "a", 1.0), (1, "b", 1.0), (2, "a", None), (2, "a", None), (None, "a", 1.0), (None, "a", 1.0)]
    lines = stored_by(spark.createDataFrame(rows, "k long, v string, w double"), "k", lambda df: df.na.drop(subset=["k"]).dropDuplicates())
    assert sorted(map(str, lines.collect())) == sorted(map(str, spark.createDataFrame([(1, "a", 1.0), (1, "b", 1.0), (2, "a", None)], "k long, v string, w double").collect()))
    assert "hashpartitioning" not in plan_of(lines.groupBy("k").count())


def test_star_join_makes_its_lines_once(spark):
    plan = plan_of(catalog.queries()["star_join"](spark, FOLDER))
    # Days alone are dealt by date: they are broadcast to the lines.
    assert "lineitem" not in plan and plan.count("hashpartitioning(Date") == 1
    # No bucket holds all lines of one customer.
    assert "Bucketed: true" not in plan


def test_star_join_of_stored_lines(spark, make_lines):
    day = "2011-03-05 10:00:00"
    inputs = Inputs(spark, "unused")
    inputs.raw = make_lines(
        ("1", "A", "cup", 2, day, 1.5, 7, "eire"),
        ("1", "A", "cup", 2, day, 1.5, 7, "eire"),  # a copy
        ("2", "A", None, 1, "2011-03-07 09:00:00", 1.5, 7, "France"),
        ("C3", "A", "CUP", -1, day, 0.0, 8, None),
        ("4", "B", None, 1, day, 2.0, 8, "Spain"),
        ("5", "B", "jar", 1, day, 0.0, 8, "Spain"),  # a bad price
        ("6", "A", "cup", 1, day, 1.5, None, "Spain"),  # an unknown customer
        ("7", None, "jug", 1, day, 1.0, 9, "Spain"),  # meets no product
        ("8", "A", "cup", 1, None, 1.0, 9, "Spain"),  # meets no day
        (None, "A", "cup", 1, day, 1.0, 9, "Spain"),
    )
    got = rows(star.star_join(*inputs.star_tables), "InvoiceNo", "StockCode", "CustomerID", "Quantity", "TotalAmount", "MonthName", "IsWeekend", "ProductName", "CustomerCountry", "CustomerOrders")
    assert got == [
        ("1", "A", 7, 2, 3.0, "March", 1, "cup", "Ireland", 2),
        ("2", "A", 7, 1, 1.5, "March", 0, "cup", "Ireland", 2),
        ("4", "B", 8, 1, 2.0, "March", 1, "UNKNOWN", None, 2),
        ("C3", "A", 8, -1, 0.0, "March", 1, "cup", None, 2),
        (None, "A", 9, 1, 1.0, "March", 1, "cup", "Spain", 2),
    ]


@pytest.mark.parametrize("keep", [stored, lambda df: stored_by(df, "k")])
def test_shuffle_files_go_once_the_table_is_written(spark, keep):
    def shuffled():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {b for i in range(blocks.size()) if (b := blocks.apply(i).toString()).startswith("shuffle_")}

    before = shuffled()
    table = keep(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    deadline = time.time() + 20
    while shuffled() - before and time.time() < deadline:  # deletion runs beside the driver
        time.sleep(0.2)
    assert not shuffled() - before
    assert table.count() == 10


@pytest.mark.parametrize("name", ["pareto", "pareto_80"])
def test_ranked_customers_are_made_once(spark, name):
    assert "lineitem" not in plan_of(catalog.queries()[name](spark, FOLDER))


def test_stored_customers_are_ranked_alike(spark):
    lines = [(1, 10.0), (1, 20.0), (2, 30.0), (3, 40.0), (None, 60.0), (4, None)]
    got = pareto.pareto(spark.createDataFrame(lines, "CustomerID long, TotalAmount double")).collect()
    assert sorted(map(tuple, got), key=lambda r: r[3]) == [
        (None, 60.0, 37.5, 20.0),
        (3, 40.0, 62.5, 40.0),
        (1, 30.0, 81.25, 60.0),
        (2, 30.0, 100.0, 80.0),
        (4, None, 100.0, 100.0),
    ]


def test_kpis_make_their_lines_once(spark):
    assert "lineitem" not in plan_of(catalog.queries()["executive_kpis"](spark, FOLDER))


def test_kpis_of_stored_lines(spark):
    lines = [
        (1, "a", "X", "cup", "2011-01-05", 2, 10.0),
        (1, "a", "X", "jar", "2011-01-05", 1, 5.0),
        (1, "b", None, None, "2011-02-01", 1, 90.0),  # known to neither country nor product
        (2, "c", "Y", "cup", None, 3, 20.0),  # in no month
        (3, "c", "Y", "jar", "2011-03-01", 3, 30.0),  # an invoice of two customers
    ]
    schema = "CustomerID long, InvoiceNo string, Country string, Description string, at string, Quantity long, TotalAmount double"
    df = spark.createDataFrame(lines, schema).withColumn("InvoiceDate", F.col("at").cast("timestamp"))
    got = {r["kpi"]: r["label"] if r["value"] is None else r["value"] for r in kpi.executive_kpis(df).collect()}
    assert got == {
        "revenue": 155.0,
        "orders": 3.0,
        "customers": 3.0,
        "aov": pytest.approx(155 / 3),
        "revenue_per_customer": pytest.approx(155 / 3),
        "repeat_pct": pytest.approx(100 / 3),
        "items_per_order": pytest.approx(10 / 3),
        "growth_pct": 100.0,
        "retention_proxy_pct": pytest.approx(100 / 3),
        "top_country": "Y",
        "top_product": "jar",
    }
