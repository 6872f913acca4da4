"""Smoothing and flat forecasts of monthly revenue; input is the sales population.

The series has one row per calendar month, so ordering it in one task is bounded by the calendar.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.numeric import exact_sum

SMA_MONTHS = 3
EMA_ALPHA = 0.3
HORIZON = 3


def month_series(sales: DataFrame) -> DataFrame:
    return sales.groupBy(
        F.date_trunc("MONTH", "InvoiceDate").alias("month")
    ).agg(exact_sum("TotalAmount").alias("revenue"))


def revenue_sma(sales: DataFrame, months: int = SMA_MONTHS) -> DataFrame:
    """Mean of this and the preceding present months, fewer at the start."""
    window = Window.orderBy("month").rowsBetween(-(months - 1), Window.currentRow)
    return month_series(sales).select("month", "revenue", F.avg("revenue").over(window).alias("sma"))


def revenue_ema(sales: DataFrame, alpha: float = EMA_ALPHA) -> DataFrame:
    """Exponential smoothing that starts at the first value."""
    series = month_series(sales).agg(
        F.array_sort(F.collect_list(F.struct("month", "revenue"))).alias("series")
    )
    point = "struct<month:timestamp,revenue:double,ema:double>"

    def step(done, x):
        previous = F.element_at(done, -1)["ema"]
        smooth = F.when(F.size(done) == 0, x["revenue"]).otherwise(
            F.lit(alpha) * x["revenue"] + F.lit(1 - alpha) * previous
        )
        return F.concat(
            done,
            F.array(F.struct(x["month"].alias("month"), x["revenue"].alias("revenue"), smooth.alias("ema"))),
        )

    smoothed = F.aggregate("series", F.array().cast(f"array<{point}>"), step)
    return series.select(F.explode(smoothed).alias("p")).select("p.month", "p.revenue", "p.ema")


def revenue_forecast(sales: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Both methods repeat their last smoothed value for the coming months."""
    last_sma = revenue_sma(sales).agg(F.max_by("sma", "month")).scalar()
    last = revenue_ema(sales).agg(
        F.max("month").alias("last"), F.max_by("ema", "month").alias("ema_forecast")
    )
    return last.select(
        F.explode(
            F.sequence(
                F.add_months("last", F.lit(1)),
                F.add_months("last", F.lit(horizon)),
                F.expr("interval 1 month"),
            )
        ).alias("month"),
        "ema_forecast",
    ).select(
        F.col("month").cast("timestamp").alias("month"),
        last_sma.alias("sma_forecast"),
        "ema_forecast",
    )
