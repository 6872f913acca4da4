"""Mergeable summaries of the sales population, kept per month and united when asked.

A month's row holds a HyperLogLog sketch of its customers and one of its invoices, and a KLL sketch of its unit prices. Rows
are a few kilobytes each whatever the number of lines, so a stored table of them answers for any
set of months without reading a line.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of the HyperLogLog registers: 14 gives a standard error of about 0.8 %.
ACCURACY = 14
#: KLL size: 800 gives a rank error of about 0.4 %.
KLL_SIZE = 800
QUARTILES = (0.25, 0.5, 0.75)


def monthly_sketches(sales: DataFrame, accuracy: int = ACCURACY, kll_size: int = KLL_SIZE) -> DataFrame:
    """month, n_lines, customers, invoices and prices (sketches)."""
    lines = sales.select(F.date_trunc("MONTH", "InvoiceDate").alias("month"), "CustomerID", "InvoiceNo", "UnitPrice")
    return lines.groupBy("month").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.hll_sketch_agg("CustomerID", accuracy).alias("customers"),
        F.hll_sketch_agg("InvoiceNo", accuracy).alias("invoices"),
        F.kll_sketch_agg_double("UnitPrice", kll_size).alias("prices"),
    )


def monthly_customers(sketches: DataFrame) -> DataFrame:
    """Customers and invoices of each month, approximately."""
    return sketches.select(
        "month",
        "n_lines",
        F.hll_sketch_estimate("customers").alias("customers"),
        F.hll_sketch_estimate("invoices").alias("invoices"),
    )


def yearly_customers(sketches: DataFrame) -> DataFrame:
    """Different customers and invoices of each year, from the union of its months."""
    united = sketches.groupBy(F.year("month").alias("year")).agg(
        F.hll_union_agg("customers").alias("customers"), F.hll_union_agg("invoices").alias("invoices")
    )
    return united.select("year", *(F.hll_sketch_estimate(c).alias(c) for c in ("customers", "invoices")))


def price_quantiles(sketches: DataFrame, ranks: Sequence[float] = QUARTILES) -> DataFrame:
    """rank, price: approximate quantiles of all months, each a price that occurs."""
    united = sketches.agg(F.kll_merge_agg_double("prices").alias("prices"))
    found = [
        F.struct(F.lit(q).alias("rank"), F.kll_sketch_get_quantile_double("prices", F.lit(q)).alias("price"))
        for q in map(float, ranks)
    ]
    return united.select(F.inline(F.array(*found)))
