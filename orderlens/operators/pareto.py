"""Cumulative revenue of customers ranked by revenue; input is the sales population."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.durable import stored
from orderlens.functions.numeric import EXACT, percent
from orderlens.functions.ordering import running_totals


def pareto(sales: DataFrame) -> DataFrame:
    """The customers are written once: split points, sums, totals and the ranking itself read them."""
    customers = stored(
        sales.groupBy("CustomerID").agg(F.sum(F.col("TotalAmount").cast(EXACT)).alias("amount"))
    )
    placed = running_totals(
        customers,
        "amount",
        "CustomerID",
        {"place": F.lit(1), "upto": F.col("amount")},
        descending=True,
    )
    whole = (
        customers.agg(F.sum("amount").cast("double").alias("amount"), F.count(F.lit(1)).alias("n"))
        .select(F.struct("amount", "n"))
        .scalar()
    )
    return placed.select(
        "CustomerID",
        F.col("amount").cast("double").alias("revenue"),
        percent("upto", whole["amount"]).alias("cum_pct"),
        percent("place", whole["n"]).alias("pct_customers"),
    )


def pareto_80(sales: DataFrame, pct: float = 80.0) -> DataFrame:
    """How many of the best customers stay below ``pct`` of revenue, and their share."""
    return (
        pareto(sales)
        .agg(
            F.count_if(F.col("cum_pct") < pct).alias("customers_below"),
            F.count(F.lit(1)).alias("customers"),
        )
        .withColumn("pct_customers", percent("customers_below", "customers"))
    )
