"""Revenue over time, countries and hours; input is the sales population."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.numeric import EXACT, exact_sum, percent
from orderlens.functions.times import year_month


def revenue_by(sales: DataFrame, *keys: Column) -> DataFrame:
    """Revenue per key; rows with a missing key are left out."""
    grouped = sales.groupBy(*keys).agg(exact_sum("TotalAmount").alias("revenue"))
    return grouped.na.drop(subset=[c for c in grouped.columns if c != "revenue"])


def sales_totals(sales: DataFrame) -> DataFrame:
    """Lines collapse to one row per invoice before the distinct count."""
    per_order = sales.groupBy("InvoiceNo").agg(
        F.sum(F.col("TotalAmount").cast(EXACT)).alias("amount"),
        F.sum("Quantity").alias("items"),
    )
    return per_order.agg(
        F.sum("amount").cast("double").alias("revenue"),
        F.count("InvoiceNo").alias("orders"),
        F.sum("items").alias("items"),
    ).withColumn("aov", F.try_divide("revenue", F.col("orders").cast("double")))


def monthly_revenue(sales: DataFrame) -> DataFrame:
    return revenue_by(sales, year_month("InvoiceDate").alias("YearMonth"))


def peak_month(sales: DataFrame) -> DataFrame:
    return monthly_revenue(sales).orderBy(F.desc("revenue"), "YearMonth").limit(1)


def revenue_by_country(sales: DataFrame, k: int = 10) -> DataFrame:
    """The k best countries with their share of all revenue."""
    by_country = revenue_by(sales, F.col("Country"))
    total = sales.agg(exact_sum("TotalAmount")).scalar()
    top = by_country.orderBy(F.desc("revenue"), "Country").limit(k)
    return top.select("Country", "revenue", percent("revenue", total).alias("pct_of_total"))


def with_rank(top: DataFrame, value: str, key: str) -> DataFrame:
    """Number the rows of a top-k result (k rows, so one task is fine)."""
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(value), key)))


def revenue_by_country_top10(sales: DataFrame, k: int = 10) -> DataFrame:
    return with_rank(revenue_by_country(sales, k), "revenue", "Country")


def revenue_by_country_top15(sales: DataFrame, k: int = 15) -> DataFrame:
    return revenue_by(sales, F.col("Country")).orderBy(F.desc("revenue"), "Country").limit(k)


def _flag_best(grouped: DataFrame, key: str, flag: str) -> DataFrame:
    best = grouped.agg(F.max_by(key, F.struct(F.col("revenue"), -F.col(key)))).scalar()
    return grouped.withColumn(flag, F.col(key) == best)


def revenue_by_weekday(sales: DataFrame) -> DataFrame:
    """Monday is 0; days without sales do not appear."""
    at = F.col("InvoiceDate")
    days = revenue_by(
        sales, F.weekday(at).alias("weekday_no"), F.date_format(at, "EEEE").alias("DayOfWeek")
    )
    return _flag_best(days, "weekday_no", "is_best")


def revenue_by_hour(sales: DataFrame) -> DataFrame:
    return _flag_best(revenue_by(sales, F.hour("InvoiceDate").alias("Hour")), "Hour", "is_peak")


def monthly_orders(sales: DataFrame) -> DataFrame:
    return sales.groupBy(year_month("InvoiceDate").alias("YearMonth")).agg(
        F.countDistinct("InvoiceNo").alias("orders")
    )
