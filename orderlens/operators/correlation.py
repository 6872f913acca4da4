"""Pearson correlations between customer features, in long form."""

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.durable import durable
from orderlens.functions.numeric import exact_mean, exact_sum
from orderlens.functions.times import whole_days
from orderlens.operators.features import NUMERIC_FEATURES, reference_date

STRONG = 0.7


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature_a, feature_b, r for every pair of columns (a before b), from one pass over the rows.

    Each pair uses the rows that have both its values; null and NaN count as missing. Null where a
    column does not vary on these rows, or none is left. Every row meets every pair inside its task,
    and only the co-moments of the pairs leave it.
    """
    spark = df.sparkSession
    pairs = list(combinations(range(len(columns)), 2))
    values = [F.when(~F.isnan(x), x) for x in (F.col(c).cast("double") for c in columns)]
    # A row of nulls adds to no pair, but makes all pairs known.
    nothing = spark.range(1).select(F.array(*[F.lit(None).cast("double") for _ in columns]).alias("v"))
    every = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in pairs])).alias("pair")
    rows = df.select(F.array(*values).alias("v")).union(nothing).select("v", every)
    x, y = F.get("v", F.col("pair.i")), F.get("v", F.col("pair.j"))
    points = rows.select("pair.i", "pair.j", F.when(y.isNotNull(), x).alias("x"), F.when(x.isNotNull(), y).alias("y"))
    r = F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))
    names = F.array(*[F.lit(c) for c in columns])
    found = points.groupBy("i", "j").agg(r.alias("r"))
    return found.select(F.get(names, F.col("i")).alias("feature_a"), F.get(names, F.col("j")).alias("feature_b"), "r")


SEVEN_FEATURES = [
    "Recency",
    "Frequency",
    "Monetary",
    "AvgOrderValue",
    "TotalItems",
    "UniqueProducts",
    "AvgUnitPrice",
]


def seven_features(sales: DataFrame) -> DataFrame:
    """``AvgOrderValue`` is the mean line amount here."""
    per_customer = durable(sales.groupBy("CustomerID").agg(
        F.max("InvoiceDate").alias("_last"),
        F.countDistinct("InvoiceNo").alias("Frequency"),
        exact_sum("TotalAmount").alias("Monetary"),
        exact_mean("TotalAmount").alias("AvgOrderValue"),
        F.sum("Quantity").alias("TotalItems"),
        F.countDistinct("StockCode").alias("UniqueProducts"),
        exact_mean("UnitPrice").alias("AvgUnitPrice"),
    ))
    recency = whole_days(F.col("_last"), reference_date(per_customer, "_last"))
    return per_customer.withColumn("Recency", recency).drop("_last")


def feature_corr_7(sales: DataFrame) -> DataFrame:
    return correlations(seven_features(sales), SEVEN_FEATURES)


def top_correlations(sales: DataFrame, k: int = 5) -> DataFrame:
    return (
        feature_corr_7(sales)
        .filter(F.col("r").isNotNull())
        .orderBy(F.desc(F.abs("r")), "feature_a", "feature_b")
        .limit(k)
    )


def feature_corr_all(features: DataFrame) -> DataFrame:
    """Input: the customer features."""
    return correlations(features, NUMERIC_FEATURES)


def strong_correlations(features: DataFrame, limit: float = STRONG) -> DataFrame:
    return feature_corr_all(features).filter(F.abs("r") > limit)
