import random
from collections import Counter
from datetime import datetime
from itertools import combinations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlens.operators import anomaly, basket, correlation, forecast, kpi, sales


def monthly(spark, values):
    data = [("i", "s", datetime(2011, m, 15), float(v)) for m, v in enumerate(values, 1)]
    return spark.createDataFrame(
        data, "InvoiceNo string, StockCode string, InvoiceDate timestamp, TotalAmount double"
    )


def test_smoothing_and_flat_forecast(spark):
    sma = forecast.revenue_sma(monthly(spark, [0, 1, 4, 9, 16])).orderBy("month").collect()
    assert [r["sma"] for r in sma] == pytest.approx([0, 0.5, 5 / 3, 14 / 3, 29 / 3])
    series = monthly(spark, [10, 20, 30])
    ema = forecast.revenue_ema(series).orderBy("month").collect()
    assert [r["ema"] for r in ema] == pytest.approx([10, 13, 18.1])
    coming = forecast.revenue_forecast(series).orderBy("month").collect()
    assert [r["month"] for r in coming] == [datetime(2011, m, 1) for m in (4, 5, 6)]
    assert {round(r["ema_forecast"], 6) for r in coming} == {18.1}
    assert {r["sma_forecast"] for r in coming} == {20.0}


def test_pairs_equal_brute_force_with_one_giant_basket(spark):
    rng = random.Random(1)
    names = [f"item {i:03d}" for i in range(40)]
    data = [("hot", f"name {i % 700:04d}") for i in range(2100)]
    data += [(f"inv {rng.randrange(300)}", rng.choice(names)) for _ in range(3000)]
    data += [("inv 1", None)]
    df = spark.createDataFrame(data, "InvoiceNo string, Description string").repartition(8)
    baskets = {}
    for invoice, name in data:
        if name is not None:
            baskets.setdefault(invoice, set()).add(name)
    for most in (None, 10):
        expected = Counter(p for b in baskets.values() for p in combinations(sorted(b)[:most], 2))
        got = {(r["item_a"], r["item_b"]): r["n"] for r in basket.pair_counts(df, most).collect()}
        assert got == expected
        best = basket.product_pairs(df, k=5, max_items=most).collect()
        ordered = sorted(expected.items(), key=lambda p: (-p[1], p[0]))[:5]
        assert [((r["item_a"], r["item_b"]), r["n"]) for r in best] == ordered


def test_anomalies(spark):
    days = [("i", "s", datetime(2011, 1, d), 100.0 if d != 9 else 9000.0) for d in range(1, 29)]
    df = spark.createDataFrame(
        days, "InvoiceNo string, StockCode string, InvoiceDate timestamp, TotalAmount double"
    ).withColumns({"CustomerID": F.lit(1), "Quantity": F.lit(1), "UnitPrice": F.lit(1.0)})
    odd = anomaly.daily_anomalies(df).filter("is_anomaly").collect()
    assert [r["day"] for r in odd] == [datetime(2011, 1, 9)]
    assert rows(anomaly.iqr_outliers(df), "TotalAmount") == [(9000.0,)]
    assert anomaly.amount_hist(df, bins=4).agg(F.sum("n")).first()[0] == 27


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0)], "a double, b double, c double")
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in correlation.correlations(df, "abc").collect()}
    assert got[("a", "b")] == pytest.approx(1.0)
    assert got[("a", "c")] is None


def test_kpis_compare_last_with_first_month(spark):
    df = monthly(spark, [100, 300, 50]).withColumns(
        {"CustomerID": F.lit(1), "Quantity": F.lit(2), "Country": F.lit("X"), "Description": F.lit(None).cast("string")}
    )
    got = {r["kpi"]: r["value"] if r["value"] is not None else r["label"] for r in kpi.executive_kpis(df).collect()}
    assert got["growth_pct"] == -50.0 and got["revenue"] == 450.0 and got["orders"] == 1.0
    assert got["top_country"] == "X" and got["top_product"] is None
    assert len(got) == 11


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(c, 1.0) for c in "dcba"], "Country string, TotalAmount double")
    assert [r["Country"] for r in sales.revenue_by_country(df, 2).collect()] == ["a", "b"]
