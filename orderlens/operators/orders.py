"""Order values and cancellations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.durable import stored
from orderlens.functions.numeric import exact_mean, exact_sum, percent
from orderlens.functions.quantiles import quantile_limits
from orderlens.functions.times import year_month
from orderlens.operators.products import clipped_histogram


def order_values(sales: DataFrame) -> DataFrame:
    return sales.groupBy("InvoiceNo").agg(exact_sum("TotalAmount").alias("amount"))


def aov_monthly(sales: DataFrame) -> DataFrame:
    """An invoice that spans two months counts in each with that month's amount."""
    per_month = sales.groupBy(
        year_month("InvoiceDate").alias("YearMonth"), "InvoiceNo"
    ).agg(exact_sum("TotalAmount").alias("amount"))
    return per_month.groupBy("YearMonth").agg(exact_mean("amount").alias("aov"))


def aov_overall(sales: DataFrame) -> DataFrame:
    return order_values(sales).agg(exact_mean("amount").alias("aov"))


def order_size_hist(sales: DataFrame, q: float = 0.95, bins: int = 50) -> DataFrame:
    return clipped_histogram(order_values(sales), "amount", q, bins)


def median_and_mean(values: DataFrame, value: str) -> DataFrame:
    # The passes of the median and the mean read the values, not what they were made from.
    values = stored(values.select(value))
    median = quantile_limits(values, value, {"median": 0.5})["median"]
    return values.agg(exact_mean(value).alias("mean")).select(median.alias("median"), "mean")


def order_size_stats(sales: DataFrame) -> DataFrame:
    return median_and_mean(order_values(sales), "amount")


def cancellation_rate_monthly(lines: DataFrame) -> DataFrame:
    """Input: lines with cancellations.

    ``cancel_rate`` sets cancelled lines against distinct invoices (mixed grain, may pass 100);
    ``cancel_invoice_rate`` sets cancelled invoices against all.
    """
    per_invoice = lines.groupBy(
        year_month("InvoiceDate").alias("YearMonth"), "InvoiceNo", "IsCancelled"
    ).agg(F.count(F.lit(1)).alias("lines"))
    return (
        per_invoice.groupBy("YearMonth")
        .agg(
            F.count("InvoiceNo").alias("total_invoices"),
            F.coalesce(F.sum(F.when(F.col("IsCancelled") == 1, F.col("lines"))), F.lit(0)).alias(
                "cancelled"
            ),
            F.count_if(F.col("IsCancelled") == 1).alias("cancelled_invoices"),
        )
        .select(
            "YearMonth",
            "total_invoices",
            "cancelled",
            percent("cancelled", "total_invoices").alias("cancel_rate"),
            percent("cancelled_invoices", "total_invoices").alias("cancel_invoice_rate"),
        )
    )


def cancellation_rate_summary(lines: DataFrame) -> DataFrame:
    return cancellation_rate_monthly(lines).agg(
        F.avg("cancel_rate").alias("mean_cancel_rate"),
        F.min_by("YearMonth", F.struct(-F.col("cancel_rate"), F.col("YearMonth"))).alias(
            "worst_month"
        ),
    )
