"""Executive KPIs, lifetime value and revenue against orders; input is the sales population."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.durable import stored
from orderlens.functions.histogram import histogram
from orderlens.functions.numeric import EXACT, exact_sum, percent
from orderlens.functions.quantiles import quantile_limits
from orderlens.functions.times import year_month
from orderlens.operators.customers import revenue_per_customer
from orderlens.operators.orders import median_and_mean
from orderlens.operators.sales import revenue_by


def _best(sales: DataFrame, key: str) -> Column:
    by_key = revenue_by(sales, F.col(key))
    top = by_key.orderBy(F.desc("revenue"), key).limit(1)
    return top.select(key).scalar()


def executive_kpis(sales: DataFrame) -> DataFrame:
    """kpi, value, label: numbers in ``value``, names in ``label``.

    Growth sets the last month against the first; the retention proxy equals the repeat rate. What
    the figures need of the lines is written once, as each of them reads it.
    """
    sales = stored(
        sales.select(
            "CustomerID",
            "InvoiceNo",
            "Country",
            "Description",
            year_month("InvoiceDate").alias("month"),
            "Quantity",
            "TotalAmount",
        )
    )
    per_order = sales.groupBy("CustomerID", "InvoiceNo").agg(
        F.sum(F.col("TotalAmount").cast(EXACT)).alias("amount"),
        F.sum("Quantity").alias("items"),
    )
    totals = per_order.agg(
        F.sum("amount").cast("double").alias("revenue"),
        F.countDistinct("InvoiceNo").cast("double").alias("orders"),
        F.countDistinct("CustomerID").cast("double").alias("customers"),
        F.sum("items").cast("double").alias("items"),
    )
    repeat = (
        per_order.groupBy("CustomerID")
        .agg(F.count(F.lit(1)).alias("orders"))
        .agg(F.count_if(F.col("orders") > 1).cast("double"))
        .scalar()
    )
    months = revenue_by(sales, F.col("month"))
    ends = (
        months.agg(
            F.min_by("revenue", "month").alias("first"), F.max_by("revenue", "month").alias("last")
        )
        .select(F.struct("first", "last"))
        .scalar()
    )
    wide = totals.select(
        "revenue",
        "orders",
        "customers",
        F.try_divide("revenue", "orders").alias("aov"),
        F.try_divide("revenue", "customers").alias("revenue_per_customer"),
        percent(repeat, "customers").alias("repeat_pct"),
        F.try_divide("items", "orders").alias("items_per_order"),
        percent(ends["last"] - ends["first"], ends["first"]).alias("growth_pct"),
        percent(repeat, "customers").alias("retention_proxy_pct"),
        _best(sales, "Country").alias("top_country"),
        _best(sales, "Description").alias("top_product"),
    )
    names = [c for c in wide.columns if not c.startswith("top_")]
    rows = [
        F.struct(F.lit(c).alias("kpi"), F.col(c).alias("value"), F.lit(None).cast("string").alias("label"))
        for c in names
    ] + [
        F.struct(F.lit(c).alias("kpi"), F.lit(None).cast("double").alias("value"), F.col(c).alias("label"))
        for c in ("top_country", "top_product")
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.kpi", "r.value", "r.label")


def clv_hist(sales: DataFrame, q: float = 0.99, bins: int = 50) -> DataFrame:
    """Revenue per customer; customers above the q-quantile are left out of the picture."""
    revenues = stored(revenue_per_customer(sales).select("revenue"))
    limit = quantile_limits(revenues, "revenue", {"q": q})["q"]
    return histogram(revenues, "revenue", bins, keep_below=limit)


def clv_stats(sales: DataFrame) -> DataFrame:
    return median_and_mean(revenue_per_customer(sales), "revenue")


def revenue_vs_orders(sales: DataFrame, q: float = 0.99) -> DataFrame:
    """One row per customer, with the q-quantiles of both measures as view limits."""
    customers = stored(
        sales.groupBy("CustomerID").agg(
            exact_sum("TotalAmount").alias("Revenue"),
            F.countDistinct("InvoiceNo").alias("Orders"),
        )
    )
    revenue_limit = quantile_limits(customers, "Revenue", {"q": q})["q"]
    orders_limit = customers.agg(F.percentile("Orders", F.lit(q))).scalar()
    return customers.withColumns(
        {"revenue_limit": revenue_limit, "orders_limit": orders_limit}
    )
