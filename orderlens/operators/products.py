"""Product rankings and distributions; input is the sales population."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.durable import stored
from orderlens.functions.histogram import histogram
from orderlens.functions.numeric import exact_mean, exact_sum
from orderlens.functions.quantiles import quantile_limits
from orderlens.operators.customers import count_stats


def product_count(sales: DataFrame) -> DataFrame:
    return sales.agg(F.countDistinct("StockCode").alias("products"))


def _top_products(sales: DataFrame, measure: Column, name: str, k: int) -> DataFrame:
    return (
        sales.filter(F.col("StockCode").isNotNull() & F.col("Description").isNotNull())
        .groupBy("StockCode", "Description")
        .agg(measure.alias(name))
        .orderBy(F.desc(name), "StockCode", "Description")
        .limit(k)
    )


def top_products_revenue(sales: DataFrame, k: int = 20) -> DataFrame:
    return _top_products(sales, exact_sum("TotalAmount"), "revenue", k)


def top_products_quantity(sales: DataFrame, k: int = 20) -> DataFrame:
    return _top_products(sales, F.sum("Quantity"), "quantity", k)


def clipped_histogram(df: DataFrame, value: str, q: float, bins: int) -> DataFrame:
    """Histogram after moving values above their q-quantile down to it."""
    values = stored(df.select(value))
    limit = quantile_limits(values, value, {"q": q})["q"]
    return histogram(values, value, bins, clip=limit)


def price_hist(sales: DataFrame, q: float = 0.95, bins: int = 50) -> DataFrame:
    return clipped_histogram(sales, "UnitPrice", q, bins)


def price_stats(sales: DataFrame) -> DataFrame:
    prices = stored(sales.select("UnitPrice"))
    median = quantile_limits(prices, "UnitPrice", {"median": 0.5})["median"]
    return prices.agg(
        exact_mean("UnitPrice").alias("mean"),
        F.min("UnitPrice").alias("min"),
        F.max("UnitPrice").alias("max"),
    ).select(median.alias("median"), "mean", "min", "max")


def products_per_invoice(sales: DataFrame) -> DataFrame:
    return sales.groupBy("InvoiceNo").agg(F.countDistinct("StockCode").alias("products"))


def products_per_invoice_hist(sales: DataFrame, clip: int = 50, bins: int = 50) -> DataFrame:
    return histogram(products_per_invoice(sales), "products", bins, clip=F.lit(clip))


def products_per_invoice_stats(sales: DataFrame) -> DataFrame:
    return count_stats(products_per_invoice(sales), "products")
