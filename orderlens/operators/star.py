"""Customer, product and date dimensions of the fact lines, and the star join."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.distinct import distinct_counts
from orderlens.functions.numeric import EXACT
from orderlens.functions.times import whole_days


def dim_customers(fact: DataFrame, in_buckets: bool = False) -> DataFrame:
    """``AvgOrderValue`` is the mean line amount, and revenue is net of returns.

    Country is the one of the earliest line, ties alphabetical, as lines have no file order. Lines
    add up per (customer, country) first; the distinct counts are a pass of their own, which needs
    no removal of copies. ``in_buckets`` says that the lines are stored in buckets of the customer.
    """
    per_country = fact.groupBy("CustomerID", "Country").agg(
        F.min("InvoiceDate").alias("first"),
        F.max("InvoiceDate").alias("last"),
        F.sum("Quantity").alias("items"),
        F.sum(F.col("TotalAmount").cast(EXACT)).alias("amount"),
        F.count("TotalAmount").cast("double").alias("lines"),
    )
    totals = per_country.groupBy("CustomerID").agg(
        F.min_by("Country", F.struct("first", "Country")).alias("Country"),
        F.min("first").alias("FirstPurchaseDate"),
        F.max("last").alias("LastPurchaseDate"),
        F.sum("items").alias("TotalItems"),
        F.sum("amount").cast("double").alias("TotalRevenue"),
        F.try_divide(F.sum("amount").cast("double"), F.sum("lines")).alias("AvgOrderValue"),
    )
    variety = distinct_counts(fact, "CustomerID", {"TotalOrders": "InvoiceNo", "UniqueProducts": "StockCode"}, in_buckets)
    return totals.join(variety, "CustomerID").select(
        "CustomerID",
        "Country",
        "FirstPurchaseDate",
        "LastPurchaseDate",
        "TotalOrders",
        "TotalItems",
        "TotalRevenue",
        "AvgOrderValue",
        "UniqueProducts",
        whole_days(F.col("FirstPurchaseDate"), F.col("LastPurchaseDate")).alias(
            "CustomerTenureDays"
        ),
    )


def dim_products(fact: DataFrame) -> DataFrame:
    """Lines add up per (product, name) first, which also settles the most frequent name."""
    per_name = fact.groupBy("StockCode", "Description").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("UnitPrice").cast(EXACT)).alias("prices"),
        F.count("UnitPrice").alias("priced"),
        F.min("UnitPrice").alias("low"),
        F.max("UnitPrice").alias("high"),
        F.sum("Quantity").alias("items"),
        F.sum(F.col("TotalAmount").cast(EXACT)).alias("amount"),
    )
    totals = per_name.groupBy("StockCode").agg(
        F.min_by("Description", F.struct(-F.col("lines"), F.col("Description"))).alias(
            "Description"
        ),
        F.try_divide(F.sum("prices").cast("double"), F.sum("priced").cast("double")).alias(
            "AvgUnitPrice"
        ),
        F.min("low").alias("MinUnitPrice"),
        F.max("high").alias("MaxUnitPrice"),
        F.sum("items").alias("TotalQtySold"),
        F.sum("amount").cast("double").alias("TotalRevenue"),
    )
    orders = fact.groupBy("StockCode").agg(F.countDistinct("InvoiceNo").alias("TimesOrdered"))
    return totals.join(orders, "StockCode").select(
        "StockCode",
        "Description",
        "AvgUnitPrice",
        "MinUnitPrice",
        "MaxUnitPrice",
        "TotalQtySold",
        "TotalRevenue",
        "TimesOrdered",
    )


def dim_date(fact: DataFrame) -> DataFrame:
    """One row per day that has lines."""
    day = F.col("Date")
    return (
        fact.select(F.date_trunc("DAY", "InvoiceDate").alias("Date"))
        .distinct()
        .select(
            "Date",
            F.year(day).alias("Year"),
            F.month(day).alias("Month"),
            F.date_format(day, "MMMM").alias("MonthName"),
            F.quarter(day).alias("Quarter"),
            F.date_format(day, "EEEE").alias("DayOfWeek"),
            F.dayofmonth(day).alias("DayOfMonth"),
            F.weekofyear(day).alias("WeekOfYear"),
            F.weekday(day).isin(5, 6).cast("int").alias("IsWeekend"),
            F.date_format(day, "yyyy-MM-dd").alias("DateKey"),
        )
    )


def star_join(
    fact: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame
) -> DataFrame:
    """Fact lines with attributes of their three dimensions.

    Dimensions are unique on their key, so lines never multiply. Small ones are broadcast by the
    engine's size check; otherwise adaptive execution splits hot customers and products. Names of
    products and of months come last, so no shuffle of lines carries them; days are few, so they
    are broadcast.
    """
    def attributes(dim: DataFrame, key: str, **names: str) -> DataFrame:
        return dim.select(key, *[F.col(c).alias(n) for n, c in names.items()])

    lines = fact.select(
        "InvoiceNo",
        "StockCode",
        "CustomerID",
        "Quantity",
        "TotalAmount",
        F.date_trunc("DAY", "InvoiceDate").alias("Date"),
    )
    return (
        lines.join(
            attributes(
                customers, "CustomerID", CustomerCountry="Country", CustomerOrders="TotalOrders"
            ),
            "CustomerID",
        )
        .join(attributes(products, "StockCode", ProductName="Description"), "StockCode")
        .join(
            F.broadcast(attributes(dates, "Date", MonthName="MonthName", IsWeekend="IsWeekend")),
            "Date",
        )
        .select(
            "CustomerID",
            "StockCode",
            "Date",
            "InvoiceNo",
            "Quantity",
            "TotalAmount",
            "MonthName",
            "IsWeekend",
            "ProductName",
            "CustomerCountry",
            "CustomerOrders",
        )
    )


def in_period(
    lines: DataFrame,
    date_from: str | None = None,
    date_to: str | None = None,
    countries: list[str] | None = None,
) -> DataFrame:
    """Date and country slicers for any line table; both ends of the period are included."""
    at = F.col("InvoiceDate")
    if date_from is not None:
        lines = lines.filter(at >= F.lit(date_from).cast("timestamp"))
    if date_to is not None:
        lines = lines.filter(at < F.date_add(F.lit(date_to).cast("date"), 1).cast("timestamp"))
    if countries is not None:
        lines = lines.filter(F.col("Country").isin(countries))
    return lines
