"""The documented warehouse form of orders: discount and profit, location, product categories."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.numeric import EXACT, exact_sum
from orderlens.operators.star import dim_date


def clean_orders(orders: DataFrame) -> DataFrame:
    """Copies removed, missing quantity and discount read as zero, quantity above zero kept.

    A free line stays here, unlike in the sales population.
    """
    return (
        orders.dropDuplicates()
        .na.fill({"Quantity": 0, "discount": 0.0})
        .filter((F.col("Quantity") > 0) & (F.col("UnitPrice") >= 0))
    )


def line_economics(orders: DataFrame, cost: str | None = None) -> DataFrame:
    """Adds sales and discount amount, and profit when a cost column is named."""
    priced = orders.withColumn("sales", F.col("Quantity") * F.col("UnitPrice")).withColumn(
        "discount_amount", F.col("sales") * F.col("discount")
    )
    if cost is None:
        return priced
    return priced.withColumn("profit", F.col("sales") - F.col(cost))


def location_id() -> Column:
    return F.concat_ws("/", "region", "country")


def dim_location(orders: DataFrame) -> DataFrame:
    return orders.select("region", "country").distinct().withColumn("location_id", location_id())


def dim_product(orders: DataFrame) -> DataFrame:
    """Categories by ``product_id``, the key of ``fact_orders``."""
    return orders.select(F.col("StockCode").alias("product_id"), "category", "sub_category").distinct()


def dim_date_doc(orders: DataFrame) -> DataFrame:
    """The days of the cleaned orders with ``date_id``, the key of ``fact_orders``."""
    return dim_date(clean_orders(orders)).withColumn("date_id", F.date_format("Date", "yyyyMMdd").cast("int"))


def fact_orders(orders: DataFrame, cost: str | None = None) -> DataFrame:
    """Order lines with the keys of their dimensions and their measures."""
    lines = line_economics(clean_orders(orders), cost)
    measures = ["Quantity", "UnitPrice", "discount", "sales", "discount_amount"]
    return lines.select(
        F.col("InvoiceNo").alias("order_id"),
        F.col("CustomerID").alias("customer_id"),
        F.col("StockCode").alias("product_id"),
        F.date_format("InvoiceDate", "yyyyMMdd").cast("int").alias("date_id"),
        location_id().alias("location_id"),
        *measures,
        *(["profit"] if cost else []),
    )


def revenue_by_region(orders: DataFrame) -> DataFrame:
    return (
        line_economics(clean_orders(orders))
        .groupBy("region")
        .agg(exact_sum("sales").alias("revenue"))
    )


def top_products_profit(orders: DataFrame, cost: str, k: int = 10) -> DataFrame:
    return (
        line_economics(clean_orders(orders), cost)
        .groupBy("StockCode")
        .agg(exact_sum("profit").alias("profit"))
        .orderBy(F.desc("profit"), "StockCode")
        .limit(k)
    )


def sales_profit_totals(orders: DataFrame, cost: str | None = None) -> DataFrame:
    lines = line_economics(clean_orders(orders), cost)
    sums = {"total_sales": "sales", "total_profit": "profit"} if cost else {"total_sales": "sales"}
    return lines.agg(*[F.sum(F.col(c).cast(EXACT)).cast("double").alias(n) for n, c in sums.items()])
