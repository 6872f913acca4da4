"""Unusual days and lines; input is the sales population."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.durable import stored
from orderlens.functions.histogram import histogram
from orderlens.functions.numeric import exact_sum
from orderlens.functions.quantiles import quantile_limits

Z_LIMIT = 2.5
IQR_FACTOR = 1.5


def daily_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.date_trunc("DAY", "InvoiceDate").alias("day")).agg(
        exact_sum("TotalAmount").alias("revenue")
    )


def daily_anomalies(sales: DataFrame, limit: float = Z_LIMIT) -> DataFrame:
    """Every day with its z-score, the band around the mean, and whether it lies outside."""
    days = daily_revenue(sales)
    whole = (
        days.agg(F.avg("revenue").alias("mean"), F.stddev("revenue").alias("std"))
        .select(F.struct("mean", "std"))
        .scalar()
    )
    z = F.try_divide(F.col("revenue") - whole["mean"], whole["std"])
    return days.select(
        "day",
        "revenue",
        z.alias("z"),
        F.coalesce(F.abs(z) > limit, F.lit(False)).alias("is_anomaly"),
        (whole["mean"] - limit * whole["std"]).alias("band_low"),
        (whole["mean"] + limit * whole["std"]).alias("band_high"),
    )


def iqr_fences(sales: DataFrame, factor: float = IQR_FACTOR) -> tuple[Column, Column]:
    """The constants below and above which a line's amount is an outlier."""
    quarter = quantile_limits(sales, "TotalAmount", {"q1": 0.25, "q3": 0.75})
    spread = factor * (quarter["q3"] - quarter["q1"])
    return quarter["q1"] - spread, quarter["q3"] + spread


def iqr_outliers(sales: DataFrame, factor: float = IQR_FACTOR) -> DataFrame:
    """Lines whose amount lies strictly outside the quartile fences."""
    lines = stored(
        sales.select("InvoiceNo", "StockCode", "CustomerID", "InvoiceDate", "Quantity", "UnitPrice", "TotalAmount")
    )
    lower, upper = iqr_fences(lines, factor)
    amount = F.col("TotalAmount")
    return lines.filter((amount < lower) | (amount > upper))


def amount_hist(sales: DataFrame, bins: int = 100, factor: float = IQR_FACTOR) -> DataFrame:
    """Line amounts up to the upper fence."""
    amounts = stored(sales.select("TotalAmount"))
    return histogram(amounts, "TotalAmount", bins, keep_below=iqr_fences(amounts, factor)[1])
