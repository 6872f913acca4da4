"""Report measures on the fact lines."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.numeric import EXACT, exact_sum
from orderlens.functions.times import year_month
from orderlens.operators.features import category


def pbi_measures(fact: DataFrame) -> DataFrame:
    """Lines collapse to invoices before the distinct counts."""
    per_order = fact.groupBy("CustomerID", "InvoiceNo").agg(
        F.sum(F.col("TotalAmount").cast(EXACT)).alias("amount"),
        F.sum("Quantity").alias("items"),
    )
    return per_order.agg(
        F.sum("amount").cast("double").alias("revenue"),
        F.countDistinct("InvoiceNo").alias("orders"),
        F.countDistinct("CustomerID").alias("customers"),
        F.sum("items").alias("_items"),
    ).select(
        "revenue",
        "orders",
        F.try_divide("revenue", F.col("orders").cast("double")).alias("aov"),
        "customers",
        F.try_divide(F.col("_items").cast("double"), F.col("orders").cast("double")).alias(
            "avg_qty_per_order"
        ),
    )


def orders_by_status(fact: DataFrame) -> DataFrame:
    return fact.groupBy("IsCancellation").agg(F.countDistinct("InvoiceNo").alias("orders"))


def segment_matrix(fact: DataFrame, segments: DataFrame) -> DataFrame:
    """Customers, revenue and mean order value per segment; fact lines join as invoices."""
    per_order = fact.groupBy("CustomerID", "InvoiceNo").agg(
        F.sum(F.col("TotalAmount").cast(EXACT)).alias("amount")
    )
    return (
        per_order.join(segments.select("CustomerID", "Segment"), "CustomerID")
        .groupBy("Segment")
        .agg(
            F.countDistinct("CustomerID").alias("customers"),
            F.sum("amount").cast("double").alias("revenue"),
            F.countDistinct("InvoiceNo").alias("_orders"),
        )
        .select(
            "Segment",
            "customers",
            "revenue",
            F.try_divide("revenue", F.col("_orders").cast("double")).alias("aov"),
        )
    )


def _by_product(fact: DataFrame) -> DataFrame:
    return fact.groupBy("Description").agg(
        exact_sum("TotalAmount").alias("revenue"), F.countDistinct("InvoiceNo").alias("orders")
    )


def top_products(fact: DataFrame, k: int = 10) -> DataFrame:
    return _by_product(fact).orderBy(F.desc("revenue"), "Description").limit(k)


def bottom_products(fact: DataFrame, k: int = 10) -> DataFrame:
    return _by_product(fact).orderBy(F.asc("revenue"), "Description").limit(k)


def revenue_by_category(fact: DataFrame) -> DataFrame:
    return fact.groupBy(category().alias("category")).agg(
        exact_sum("TotalAmount").alias("revenue")
    )


def revenue_by_date(fact: DataFrame, grain: str = "day") -> DataFrame:
    period = (
        F.date_format("InvoiceDate", "yyyy-MM-dd") if grain == "day" else year_month("InvoiceDate")
    )
    return fact.groupBy(period.alias("period")).agg(exact_sum("TotalAmount").alias("revenue"))


def revenue_geo(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue by the customer dimension's country; lines join as one row per customer."""
    per_customer = fact.groupBy("CustomerID").agg(
        F.sum(F.col("TotalAmount").cast(EXACT)).alias("amount")
    )
    return (
        per_customer.join(customers.select("CustomerID", "Country"), "CustomerID")
        .groupBy("Country")
        .agg(F.sum("amount").cast("double").alias("revenue"))
    )
