"""Customer features from the sales population."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.distinct import distinct_counts
from orderlens.functions.durable import durable
from orderlens.functions.numeric import exact_mean, exact_sum
from orderlens.functions.times import DAYS_PER_MONTH, day_after, whole_days

NUMERIC_FEATURES = [
    "total_revenue",
    "total_items",
    "total_orders",
    "unique_products",
    "avg_unit_price",
    "avg_order_value",
    "avg_items_per_order",
    "customer_tenure_days",
    "recency_days",
    "revenue_per_item",
    "is_repeat_customer",
    "purchase_frequency",
    "unique_categories",
    "preferred_day",
    "preferred_hour",
]


def category(stock_code: str = "StockCode") -> Column:
    return F.substring(stock_code, 1, 2)


def reference_date(customers: DataFrame, last: str) -> Column:
    """One day after the last purchase of all customers."""
    return customers.agg(day_after(F.max(last))).scalar()


def customer_features(sales: DataFrame, in_buckets: bool = False) -> DataFrame:
    """Sixteen features per customer.

    Everything additive comes from one aggregation; its modes keep one counter per weekday, hour
    and country, domains that do not grow with the lines. The distinct counts are a second pass,
    which needs no removal of copies. The joined rows, one per customer, are written once: the
    last purchase of all is read from them, not from the lines. ``in_buckets`` says that the lines are
    stored in buckets of the customer (``stored_by``).
    """
    at = F.col("InvoiceDate")
    base = sales.groupBy("CustomerID").agg(
        exact_sum("TotalAmount").alias("total_revenue"),
        F.sum("Quantity").alias("total_items"),
        exact_mean("UnitPrice").alias("avg_unit_price"),
        F.min(at).alias("_first"),
        F.max(at).alias("_last"),
        F.mode(F.weekday(at), True).alias("preferred_day"),
        F.mode(F.hour(at), True).alias("preferred_hour"),
        F.mode("Country", True).alias("country"),
    )
    distinct = {"total_orders": "InvoiceNo", "unique_products": "StockCode", "unique_categories": category()}
    variety = distinct_counts(sales, "CustomerID", distinct, in_buckets)
    customers = durable(base.join(variety, "CustomerID"))

    orders = F.col("total_orders").cast("double")
    tenure = whole_days(F.col("_first"), F.col("_last"))
    return customers.select(
        "CustomerID",
        "total_revenue",
        "total_items",
        "total_orders",
        "unique_products",
        "avg_unit_price",
        (F.col("total_revenue") / orders).alias("avg_order_value"),
        (F.col("total_items") / orders).alias("avg_items_per_order"),
        tenure.alias("customer_tenure_days"),
        whole_days(F.col("_last"), reference_date(customers, "_last")).alias("recency_days"),
        F.try_divide("total_revenue", F.col("total_items").cast("double")).alias(
            "revenue_per_item"
        ),
        (F.col("total_orders") > 1).cast("int").alias("is_repeat_customer"),
        F.when(tenure > 0, F.try_divide(orders, tenure / F.lit(DAYS_PER_MONTH)))
        .otherwise(orders)
        .alias("purchase_frequency"),
        "unique_categories",
        "preferred_day",
        "preferred_hour",
        "country",
    )
