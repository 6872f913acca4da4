from collections import Counter
from itertools import product

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlens.operators import cluster, cohort, customers, dashboard, features, pareto, rfm
from orderlens.operators.cleaning import clean_sales


def test_all_score_triples_fall_into_the_known_segments(spark):
    df = spark.createDataFrame(
        list(product(range(1, 6), repeat=3)), "R_Score int, F_Score int, M_Score int"
    )
    counts = Counter(r["Segment"] for r in rfm.rfm_segments(df).collect())
    assert counts == {
        "Champions": 8, "Loyal Customers": 19, "New Customers": 20, "Potential Loyalists": 17,
        "Promising": 2, "Need Attention": 1, "At Risk": 18, "Lost": 20, "Hibernating": 12,
        "About to Sleep": 8,
    }


@pytest.mark.parametrize("n", [5, 7, 12, 23, 101, 1000])
def test_rank_quintiles_equal_pandas(spark, n):
    df = spark.range(1, n + 1).select(rfm.rank_quintile(F.col("id"), F.lit(n)).alias("q"))
    expected = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert [r["q"] for r in df.collect()] == list(expected)


def test_scores_equal_pandas_with_ties(spark):
    rng = np.random.default_rng(5)
    base = pd.DataFrame({
        "CustomerID": range(500),
        "Recency": rng.integers(1, 300, 500),
        "Frequency": np.where(rng.random(500) < 0.5, 1, rng.integers(1, 9, 500)),
        "Monetary": np.round(rng.exponential(100, 500), 2),
    })
    got = rfm.rfm_scores(spark.createDataFrame(base)).toPandas().sort_values("CustomerID")

    def fifth(values):
        """1 to 5: how many of the inner edges lie below a value, and one."""
        return np.searchsorted(np.percentile(values, [20, 40, 60, 80]), values, "left") + 1

    def places(column):
        """Rank of each customer, equal ones in the order of their ids."""
        out = np.empty(len(base), int)
        out[np.lexsort((base["CustomerID"], base[column]))] = np.arange(1, len(base) + 1)
        return out

    r, f, m = 6 - fifth(base["Recency"].to_numpy()), fifth(places("Frequency")), fifth(places("Monetary"))
    assert list(got["R_Score"]) == list(r)
    assert list(got["F_Score"]) == list(f)
    assert list(got["M_Score"]) == list(m)
    assert list(got["RFM_Total"]) == list(r + f + m)


@pytest.fixture(scope="module")
def sales(make_lines):
    def line(invoice, stock, at, customer, qty=1, price=2.0, country="X"):
        return (invoice, stock, f"item {stock}", qty, at, price, customer, country)

    return clean_sales(make_lines(
        line("1", "AA1", "2011-01-31 23:00:00", 1),
        line("1", "AA2", "2011-01-31 23:00:00", 1, qty=3),
        line("2", "AB1", "2011-03-01 09:00:00", 1, country="Y"),
        line("3", "AA1", "2011-02-10 09:00:00", 2, price=10.0),
        line("4", "AA1", "2011-03-05 09:00:00", 2, price=10.0),
        line("5", "ZZ1", "2011-03-05 12:00:00", 3, price=0.5),
    ))


def test_features_of_a_small_shop(sales):
    got = {r["CustomerID"]: r for r in features.customer_features(sales).collect()}
    one = got[1]
    assert (one["total_revenue"], one["total_items"], one["total_orders"]) == (10.0, 5, 2)
    assert (one["unique_products"], one["unique_categories"], one["country"]) == (3, 2, "X")
    assert (one["customer_tenure_days"], one["recency_days"]) == (28, 5)
    assert (one["preferred_day"], one["preferred_hour"], one["is_repeat_customer"]) == (0, 23, 1)
    assert one["purchase_frequency"] == pytest.approx(2 / (28 / 30.44))
    assert got[3]["purchase_frequency"] == 1.0 and got[3]["recency_days"] == 1


def test_cohorts_and_new_customers(sales):
    assert rows(cohort.cohort_counts(sales)) == [
        ("2011-01", "2011-01", 0, 1), ("2011-01", "2011-03", 2, 1), ("2011-02", "2011-02", 0, 1),
        ("2011-02", "2011-03", 1, 1), ("2011-03", "2011-03", 0, 1),
    ]
    base = cohort.cohort_retention(sales).filter("CohortIndex = 0")
    assert {r["retention_pct"] for r in base.collect()} == {100.0}
    assert cohort.cohort_retention(sales, rows=1, cols=1).count() == 1
    assert cohort.cohort_matrix(sales).columns == ["CohortMonth", "0", "1", "2"]
    assert cohort.cohort_matrix(sales, 2, 3).columns == ["CohortMonth", "0", "1", "2"]
    assert rows(customers.new_vs_returning(sales)) == [
        ("2011-01", 1, 0), ("2011-02", 1, 0), ("2011-03", 1, 2)]


def test_loyalty_and_pareto(sales):
    got = customers.customer_loyalty(sales).first()
    assert (got["customers"], got["repeat"], got["one_time"], got["label"]) == (3, 2, 1, "strong")
    ranked = pareto.pareto(sales).orderBy("pct_customers").collect()
    assert [r["CustomerID"] for r in ranked] == [2, 1, 3]
    assert ranked[-1]["cum_pct"] == 100.0 and ranked[-1]["pct_customers"] == 100.0
    assert pareto.pareto_80(sales).first()["customers_below"] == 1


def test_kmeans_finds_separate_groups_and_their_cost(spark):
    rng = np.random.default_rng(0)
    groups = [(5, 2, 100), (50, 10, 1000), (300, 1, 10), (900, 40, 90000)]
    data = [
        (i, int(r * rng.uniform(0.9, 1.1)), max(1, int(f * rng.uniform(0.9, 1.1))), float(m * rng.uniform(0.9, 1.1)))
        for i, (r, f, m) in enumerate(groups[i % 4] for i in range(200))
    ]
    base = spark.createDataFrame(data, "CustomerID long, Recency long, Frequency long, Monetary double")
    found = {r["CustomerID"]: r["Cluster"] for r in cluster.kmeans_segments(base, 4, restarts=3).collect()}
    assert len({found[i] for i in range(4)}) == 4
    assert all(found[i] == found[i % 4] for i in range(200))

    x = np.log1p(np.array([d[1:] for d in data], dtype=float))
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    cost = sum(
        ((x[i::4] - x[i::4].mean(axis=0)) ** 2).sum() for i in range(4)
    )
    elbow = {r["k"]: r["inertia"] for r in cluster.kmeans_elbow(base, [2, 4], restarts=3).collect()}
    assert elbow[4] == pytest.approx(cost, rel=1e-6) and elbow[2] > elbow[4]
    profiles = cluster.kmeans_profiles(base, 4, restarts=3).orderBy(F.desc("Avg_Monetary")).collect()
    assert [p["Label"] for p in profiles] == cluster.CLUSTER_LABELS

    covariance = np.cov(x.T)
    values = np.sort(np.linalg.eigvalsh(covariance))[::-1]
    pca = cluster.rfm_pca(base).first()
    assert pca["PC1_ratio"] == pytest.approx(values[0] / values.sum())
    assert pca["PC2_ratio"] == pytest.approx(values[1] / values.sum())


def test_dashboard_cards_of_an_empty_selection(spark):
    empty = spark.createDataFrame(
        [], "CustomerID long, total_revenue double, total_orders long, is_repeat_customer int"
    )
    got = dashboard.cards(empty).first()
    assert (got["revenue"], got["orders"], got["customers"], got["aov"]) == (0.0, 0, 0, 0.0)
