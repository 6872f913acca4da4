import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.functions.histogram import histogram
from orderlens.functions.numeric import exact_mean, exact_sum, sample_kurtosis, sample_skewness
from orderlens.functions.ordering import bucket_of, running_totals, split_points
from orderlens.functions import quantiles as quantile_module
from orderlens.functions.quantiles import quantile_limits, quantiles
from orderlens.functions.text import title_case
from orderlens.functions.times import parse_invoice_date, whole_days


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_title_case_capitalises_after_every_non_letter(spark):
    texts = ["o'neil u.s.a EIRE saint-martin", "united KINGDOM", None, "", "côte d'ivoire"]
    got = [r[0] for r in column(spark, texts, "string").select(title_case(F.col("x"))).collect()]
    assert got == ["O'Neil U.S.A Eire Saint-Martin", "United Kingdom", None, "", "Côte D'Ivoire"]


def test_dates_in_both_layouts(spark):
    texts = ["12/1/2010 8:26", "2010-12-01 08:26:00", "bad"]
    got = [r[0] for r in column(spark, texts, "string").select(parse_invoice_date(F.col("x"))).collect()]
    assert got == [datetime(2010, 12, 1, 8, 26)] * 2 + [None]


def test_whole_days_are_full_spans_of_24_hours(spark):
    pairs = [
        (datetime(2011, 1, 1, 23), datetime(2011, 1, 2, 1)),
        (datetime(2011, 1, 1, 23), datetime(2011, 1, 3, 1)),
    ]
    df = spark.createDataFrame(pairs, "a timestamp, b timestamp")
    assert [r[0] for r in df.select(whole_days(F.col("a"), F.col("b"))).collect()] == [0, 1]


def test_moments_are_bias_corrected(spark):
    df = column(spark, [1.0, 2.0, 2.0, 5.0, 9.0, 14.0, 50.0], "double")
    std, skew, kurt = df.agg(F.stddev("x"), sample_skewness("x"), sample_kurtosis("x")).first()
    assert std == pytest.approx(17.449246129165306)
    assert skew == pytest.approx(2.282087525040574)
    assert kurt == pytest.approx(5.431551690282051)


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1] * 1000 + [1e9, -1e9]
    for seed in range(3):
        random.Random(seed).shuffle(values)
        assert column(spark, values, "double").agg(exact_sum("x")).first()[0] == 100.0


@pytest.mark.parametrize("size", [1, 2, 7, 400])
def test_quantiles_equal_linear_interpolation(spark, size):
    rng = np.random.default_rng(size)
    values = np.round(rng.exponential(10, size), 1)
    df = column(spark, [float(v) for v in values] + [None, float("nan")], "double")
    points = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    got = spark.range(1).select(*[q.alias(name) for name, q in quantile_limits(df, "x", points).items()]).first()
    for name, q in points.items():
        assert got[name] == pytest.approx(np.quantile(values, q))


def test_quantiles_of_odd_columns(spark):
    assert spark.range(1).select(quantile_limits(column(spark, [None], "double"), "x", {"q": 0.5})["q"]).first()[0] is None
    assert quantiles(column(spark, [], "double").selectExpr("'a' AS g", "x"), "x", {"q": 0.5}, ["g"]).collect() == []
    # Values that coarse bins cannot tell apart, signs, extremes.
    for values in ([1e9 + i / 7 for i in range(500)], [-3.5, -0.0, 0.0, 2.5, 1e-300, -1e300, 1e300], [7.0] * 900 + [float(i) for i in range(100)], [float(np.nextafter(1.0, 2)), 1.0]):
        got = spark.range(1).select(*quantile_limits(column(spark, values, "double"), "x", {"a": 0.1, "b": 0.5, "c": 0.9}).values()).first()
        assert list(got) == pytest.approx(np.quantile(values, [0.1, 0.5, 0.9]).tolist())


def test_quantile_passes_are_few_and_order_nothing(spark):
    values = [7.0] * 9000 + [float(v) for v in np.random.default_rng(1).lognormal(3, 2, 1000)]
    df = column(spark, values, "double")
    calls = []

    def counted(rows, keys):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "Sort" not in plan
        calls.append(keys)
        return bins(rows, keys)

    bins, quantile_module._bins = quantile_module._bins, counted
    try:
        quantile_limits(df, "x", {"q1": 0.25, "q95": 0.95})
    finally:
        quantile_module._bins = bins
    assert len(calls) <= 3


def test_quantiles_by_group_with_one_heavy_value(spark):
    heavy = [("hot", 5.0)] * 3000 + [("hot", float(i)) for i in range(1000)]
    cold = [("cold", float(i)) for i in range(11)]
    df = spark.createDataFrame(heavy + cold, "g string, x double")
    got = {r["g"]: r for r in quantiles(df, "x", {"q": 0.3, "m": 0.9}, ["g"]).collect()}
    for group, data in (("hot", heavy), ("cold", cold)):
        values = [x for _, x in data]
        assert got[group]["q"] == pytest.approx(np.quantile(values, 0.3))
        assert got[group]["m"] == pytest.approx(np.quantile(values, 0.9))


def test_running_totals_over_several_partitions_and_ties(spark):
    rng = random.Random(3)
    data = [(i, rng.choice([1, 1, 1, 2, 3, rng.randrange(100)])) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(data, "id long, v long").repartition(7)
        got = running_totals(
            df, "v", "id", {"place": F.lit(1), "upto": F.col("v")}, descending=True, buckets=9
        )
        found = {r["id"]: (r["place"], r["upto"]) for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total = 0
    for place, (i, v) in enumerate(sorted(data, key=lambda p: (-p[1], p[0])), 1):
        total += v
        assert found[i] == (place, total)


def test_a_heavy_value_is_split_by_its_ties(spark):
    data = [(i, 5) for i in range(9000)] + [(9000 + i, i) for i in range(1000)]
    df = spark.createDataFrame(data, "id long, v long").repartition(5)
    for descending in (False, True):
        cuts = split_points(df, "v", "id", 10, descending)
        assert len([c for c in cuts if c[0] == 5]) >= 8
        sizes = df.groupBy(bucket_of("v", "id", cuts, "bigint", descending)).count().collect()
        assert max(r["count"] for r in sizes) <= 2200  # of 10,000 rows in ten buckets
        got = running_totals(df, "v", "id", {"place": F.lit(1)}, descending, 10)
        order = sorted(data, key=lambda p: (-p[1] if descending else p[1], p[0]))
        assert {r["id"]: r["place"] for r in got.collect()} == {i: n for n, (i, _) in enumerate(order, 1)}


def test_running_totals_shuffle_once_and_store_nothing(spark):
    df = spark.range(2000).selectExpr("id", "id % 7 AS v")
    plan = running_totals(df, "v", "id", {"place": F.lit(1)})._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.find("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert plan.count("Exchange ") == 1 and "rangepartitioning" not in plan and "SinglePartition" not in plan


def test_running_totals_of_no_rows_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 3), (3, 1)], "id long, v long").withColumn("v", F.col("v").cast("decimal(20,4)"))
    got = running_totals(df, "v", "id", {"place": F.lit(1), "upto": F.col("v")}, buckets=3)
    assert sorted((r["id"], r["place"], r["upto"]) for r in got.collect()) == [(1, 3, 4), (2, 2, 4), (3, 1, 1)]
    assert running_totals(df.limit(0), "v", "id", {"place": F.lit(1)}).collect() == []


@pytest.mark.parametrize("values", [[0.0, 1.0, 2.0, 10.0], [3.0, 3.0], [1.0, 2.5, 2.5, 4.0, 9.9]])
def test_histogram_equals_numpy(spark, values):
    got = histogram(column(spark, values, "double"), "x", 5).orderBy("bin").collect()
    n, edges = np.histogram(values, bins=5)
    assert [r["n"] for r in got] == list(n)
    assert [r["lo"] for r in got] == pytest.approx(list(edges[:-1]))
    assert got[-1]["hi"] == pytest.approx(edges[-1])


def test_histogram_clips_filters_and_weights(spark):
    df = spark.createDataFrame([(1.0, 2), (2.0, 1), (50.0, 3)], "x double, w long")
    clipped = histogram(df, "x", 2, clip=F.lit(5.0), weight="w").orderBy("bin").collect()
    assert [r["n"] for r in clipped] == [3, 3]
    kept = histogram(df, "x", 2, keep_below=F.lit(5.0)).orderBy("bin").collect()
    assert [(r["n"], r["hi"]) for r in kept] == [(1, 1.5), (1, 2.0)]
    assert histogram(df.filter("x > 99"), "x", 2).count() == 0


def test_exact_means_skip_missing_numbers_and_keep_decimals(spark):
    df = spark.createDataFrame([(0.000012,), (0.000014,), (float("nan"),), (None,)], "x double")
    row = df.agg(exact_mean("x", 6).alias("m"), exact_sum("x", 6).alias("s")).first()
    assert (round(row["m"], 9), round(row["s"], 9)) == (0.000013, 0.000026)
