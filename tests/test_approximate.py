"""Sketches against exact answers, samples by count, correlations with missing values."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderlens.operators import basket, correlation, sketches
from orderlens.plans import catalog, marts
from orderlens.plans.inputs import Inputs
from orderlens.sources.files import read_mart, write_mart


@pytest.fixture(scope="module")
def sales(spark):
    """200,000 lines of 30 months, 50,000 customers; a third of all lines belongs to one of them."""
    n = F.col("id")
    return spark.range(200_000).select(
        F.when(n % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(50_000))).alias("CustomerID"),
        F.concat(F.lit("i"), (n / 4).cast("long")).alias("InvoiceNo"),
        F.timestamp_seconds(F.lit(1_500_000_000) + n * 390).alias("InvoiceDate"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000)) / 100).alias("UnitPrice"),
    )


def test_sketches_are_close_and_unite(spark, sales, tmp_path):
    marts.build_sketches(sales, str(tmp_path))
    stored = marts.StoredInputs(spark, "", str(tmp_path)).sketches
    month = F.date_trunc("MONTH", "InvoiceDate")
    exact = {r[0]: r[1:] for r in sales.groupBy(month).agg(F.count("*"), F.countDistinct("CustomerID"), F.countDistinct("InvoiceNo")).collect()}
    got = {r[0]: r[1:] for r in sketches.monthly_customers(stored).collect()}
    assert set(got) == set(exact)
    for key, (n_lines, *counts) in exact.items():
        assert got[key][0] == n_lines and got[key][1:] == pytest.approx(counts, rel=0.03)
    exact = {r[0]: r[1:] for r in sales.groupBy(F.year("InvoiceDate")).agg(F.countDistinct("CustomerID"), F.countDistinct("InvoiceNo")).collect()}
    for r in sketches.yearly_customers(stored).collect():
        assert tuple(r[1:]) == pytest.approx(exact[r[0]], rel=0.03)
    prices = np.sort([r[0] for r in sales.select("UnitPrice").collect()])
    for q, price in sketches.price_quantiles(stored, [0.01, 0.25, 0.5, 0.99]).collect():
        assert np.searchsorted(prices, price, "left") / len(prices) - 0.01 <= q <= np.searchsorted(prices, price, "right") / len(prices) + 0.01


def test_stored_sketches_need_no_line(spark, sales, tmp_path):
    marts.build_sketches(sales, str(tmp_path))
    inputs = marts.StoredInputs(spark, "", str(tmp_path))
    for name in ("monthly_customers_approx", "yearly_customers_approx", "price_quantiles_approx"):
        files = catalog.GROUPS["sales"][name](inputs).inputFiles()
        assert files and all(marts.SKETCHES in f for f in files)


def test_sketches_of_nothing_and_of_nulls(spark, sales):
    none = sketches.monthly_sketches(sales.where("false"))
    assert sketches.monthly_customers(none).count() == 0
    nulls = sketches.monthly_sketches(sales.limit(3).withColumn("CustomerID", F.lit(None).cast("long")))
    assert [r["customers"] for r in sketches.monthly_customers(nulls).collect()] == [0]


@pytest.mark.parametrize("sample", [1, 7, 1000, 10**6])
def test_a_sample_has_exactly_so_many_invoices(sales, sample):
    picked = basket.sampled_invoices(sales, sample)
    want = min(sample, 50_000)
    assert picked.select("InvoiceNo").distinct().count() == want and picked.count() == 4 * want


def test_correlations_leave_out_missing_values_by_pair(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame(rng.normal(size=(300, 4)), columns=list("abcd")).assign(e=1.0)
    frame["b"] += frame["a"]
    for i, c in enumerate("abcd"):
        frame.loc[frame.index % (5 + i) == i, c] = np.nan
    rows = [tuple(None if k % 2 and math.isnan(v) else float(v) for v in r) for k, r in enumerate(frame.itertuples(index=False))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in "abcde"))
    want = frame.corr()
    got = correlation.correlations(df, "abcde").collect()
    assert len(got) == 10
    for r in got:
        expected = want.loc[r["feature_a"], r["feature_b"]]
        assert (r["r"] is None) if math.isnan(expected) else r["r"] == pytest.approx(expected, abs=1e-12)
    assert {r["r"] for r in correlation.correlations(df.where("false"), "abc").collect()} == {None}
