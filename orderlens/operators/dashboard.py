"""Tables behind the customer dashboard."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.histogram import bin_edges, bin_index, histogram
from orderlens.functions.numeric import exact_sum, percent
from orderlens.functions.quantiles import quantile_limits, quantiles


def customer_360(segments: DataFrame, features: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers found in all three marts, one row each.

    The features' most frequent country is renamed, as column names ignore case.
    """
    return segments.join(
        features.withColumnRenamed("country", "feature_country"), "CustomerID"
    ).join(customers, "CustomerID")


def default_countries(c360: DataFrame, k: int = 5) -> DataFrame:
    return (
        c360.filter(F.col("Country").isNotNull())
        .groupBy("Country")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "Country")
        .limit(k)
    )


def filtered(
    c360: DataFrame,
    segments: Sequence[str] | None = None,
    countries: Sequence[str] | None = None,
) -> DataFrame:
    """Customers of the chosen segments (default all) and countries (default the five largest)."""
    if segments is not None:
        chosen = c360.filter(F.col("Segment").isin(list(segments)))
    else:
        chosen = c360
    if countries is not None:
        return chosen.filter(F.col("Country").isin(list(countries)))
    largest = default_countries(c360).select("Country")
    return chosen.join(F.broadcast(largest), "Country", "left_semi")


def totals(customers: DataFrame, features: DataFrame) -> DataFrame:
    """Unfiltered headline figures; customers from the dimension, the rest from the features."""
    count = customers.agg(F.countDistinct("CustomerID")).scalar()
    return features.agg(
        exact_sum("total_revenue").alias("revenue"),
        F.sum("total_orders").alias("orders"),
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("is_repeat_customer") == 1).alias("_repeat"),
    ).select(
        count.alias("customers"),
        "revenue",
        F.try_divide("revenue", F.col("orders").cast("double")).alias("aov"),
        "orders",
        percent("_repeat", "_rows").alias("repeat_pct"),
    )


def cards(f: DataFrame) -> DataFrame:
    """Headline figures of the filtered customers; zeros when none are left."""
    orders = F.coalesce(F.sum("total_orders"), F.lit(0))
    revenue = F.coalesce(exact_sum("total_revenue"), F.lit(0.0))
    return f.agg(
        revenue.alias("revenue"),
        orders.alias("orders"),
        F.count("CustomerID").alias("customers"),
        F.coalesce(F.try_divide(revenue, orders.cast("double")), F.lit(0.0)).alias("aov"),
        percent(F.count_if(F.col("is_repeat_customer") == 1), F.count(F.lit(1))).alias(
            "repeat_pct"
        ),
    )


def segment_counts(f: DataFrame) -> DataFrame:
    return f.groupBy("Segment").agg(F.count(F.lit(1)).alias("Count"))


def segment_revenue(f: DataFrame) -> DataFrame:
    whole = f.agg(exact_sum("total_revenue")).scalar()
    return (
        f.groupBy("Segment")
        .agg(exact_sum("total_revenue").alias("total_revenue"))
        .withColumn("share", percent("total_revenue", whole))
    )


def recency_revenue(f: DataFrame) -> DataFrame:
    return f.select("CustomerID", "Recency", "total_revenue", "Segment", "total_orders")


def geo(f: DataFrame) -> DataFrame:
    """Every country of the selection; the bar chart shows the first fifteen."""
    return (
        f.filter(F.col("Country").isNotNull())
        .groupBy("Country")
        .agg(
            exact_sum("total_revenue").alias("total_revenue"),
            F.count("CustomerID").alias("customers"),
        )
        .orderBy(F.desc("total_revenue"), "Country")
    )


def preferred_day(f: DataFrame) -> DataFrame:
    return f.groupBy(F.col("preferred_day").alias("day")).agg(F.count(F.lit(1)).alias("customers"))


def preferred_hour(f: DataFrame) -> DataFrame:
    return f.groupBy(F.col("preferred_hour").alias("hour")).agg(
        F.count(F.lit(1)).alias("customers")
    )


def aov_hist(f: DataFrame, bins: int = 50, q: float = 0.95) -> DataFrame:
    """All order values in equal bins; the q-quantile is the view limit, nothing is cut."""
    limit = quantile_limits(f, "avg_order_value", {"q": q})["q"]
    return histogram(f, "avg_order_value", bins).withColumn("view_limit", limit)


def items_box(f: DataFrame, q: float = 0.95) -> DataFrame:
    """Five-number summary per segment and the overall q-quantile as view limit."""
    quarters = quantiles(
        f,
        "avg_items_per_order",
        {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0},
        ["Segment"],
    )
    limit = quantile_limits(f, "avg_items_per_order", {"q": q})["q"]
    return quarters.select(
        "Segment", "q1", "median", "q3", "min", "max", limit.alias("view_limit")
    )


def tenure_hist(f: DataFrame, bins: int = 50) -> DataFrame:
    """Customers per segment and tenure bin; the bins are the same for all segments."""
    edges = bin_edges(f, "customer_tenure_days", bins)
    edge = edges.select(F.struct("first", "width")).scalar()
    place = bin_index(
        F.col("customer_tenure_days").cast("double"), edge["first"], edge["width"], bins
    )
    return f.groupBy("Segment", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
