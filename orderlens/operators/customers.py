"""Loyalty, frequency and acquisition; input is the sales population."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.histogram import histogram
from orderlens.functions.numeric import exact_sum, percent
from orderlens.functions.times import year_month

STRONG_LOYALTY = 0.5


def orders_per_customer(sales: DataFrame) -> DataFrame:
    return sales.groupBy("CustomerID").agg(F.countDistinct("InvoiceNo").alias("orders"))


def customer_loyalty(sales: DataFrame) -> DataFrame:
    return (
        orders_per_customer(sales)
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.count_if(F.col("orders") > 1).alias("repeat"),
            F.count_if(F.col("orders") == 1).alias("one_time"),
        )
        .withColumns(
            {
                "repeat_pct": percent("repeat", "customers"),
                "one_time_pct": percent("one_time", "customers"),
            }
        )
        .withColumn(
            "label",
            F.when(F.col("repeat_pct") > STRONG_LOYALTY * 100, "strong").otherwise("moderate"),
        )
    )


def customers_by_country_top10(sales: DataFrame, k: int = 10) -> DataFrame:
    return (
        sales.filter(F.col("Country").isNotNull())
        .groupBy("Country")
        .agg(F.countDistinct("CustomerID").alias("customers"))
        .orderBy(F.desc("customers"), "Country")
        .limit(k)
    )


def order_frequency_hist(sales: DataFrame, clip: int = 30, bins: int = 30) -> DataFrame:
    return histogram(orders_per_customer(sales), "orders", bins, clip=F.lit(clip))


def count_stats(counts: DataFrame, column: str) -> DataFrame:
    """Median and mean of per-group counts.

    The median's value table stays small: d distinct counts need at least d*(d+1)/2 rows below.
    """
    return counts.agg(
        F.percentile(column, F.lit(0.5)).alias("median"),
        F.try_divide(F.sum(column).cast("double"), F.count(column).cast("double")).alias("mean"),
    )


def order_frequency_stats(sales: DataFrame) -> DataFrame:
    return count_stats(orders_per_customer(sales), "orders")


def revenue_per_customer(sales: DataFrame) -> DataFrame:
    return sales.groupBy("CustomerID").agg(exact_sum("TotalAmount").alias("revenue"))


def top_customers(sales: DataFrame, k: int = 10) -> DataFrame:
    """The k best customers, each with its own and the k customers' joint share of revenue."""
    top = revenue_per_customer(sales).orderBy(F.desc("revenue"), "CustomerID").limit(k)
    total = sales.agg(exact_sum("TotalAmount")).scalar()
    joint = top.agg(exact_sum("revenue")).scalar()
    return top.select(
        "CustomerID",
        "revenue",
        percent("revenue", total).alias("pct_of_total"),
        percent(joint, total).alias("top_k_pct"),
    )


def active_months(sales: DataFrame) -> DataFrame:
    """CustomerID, YearMonth once per month with a purchase, and the customer's first month.

    Lines collapse to at most one row per customer and month before the window, so a customer
    with very many lines is no larger than the calendar.
    """
    per_customer = Window.partitionBy("CustomerID")
    return (
        sales.select("CustomerID", year_month("InvoiceDate").alias("YearMonth"))
        .distinct()
        .withColumn("FirstMonth", F.min("YearMonth").over(per_customer))
    )


def new_vs_returning(sales: DataFrame) -> DataFrame:
    is_new = F.col("YearMonth") == F.col("FirstMonth")
    return (
        active_months(sales)
        .groupBy("YearMonth")
        .agg(F.count_if(is_new).alias("new"), F.count_if(~is_new).alias("returning"))
    )
