"""The three line populations, the ETL audit and the schema check.

* fact: cancellations and returns kept and flagged, country names standardized
* sales: only paid, positive, uncancelled lines of known customers
* with cancellations: known customers, copies removed, nothing else filtered

Copies are removed by grouping on all columns; a group of any number of copies collapses on the
map side before the shuffle.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.text import title_case
from orderlens.functions.times import year_month
from orderlens.schema import LINE_COLUMNS

UNKNOWN = "UNKNOWN"

# Country names replaced after title-casing.
COUNTRY_NAMES = {"Eire": "Ireland", "Rsa": "South Africa"}


def is_cancellation(invoice: str = "InvoiceNo") -> Column:
    return F.coalesce(F.col(invoice).startswith("C"), F.lit(False))


def is_return(quantity: str = "Quantity") -> Column:
    return F.coalesce(F.col(quantity) < 0, F.lit(False))


def has_bad_price() -> Column:
    """Free or negative price outside a cancellation; a missing price is not a bad one."""
    return F.coalesce(F.col("UnitPrice") <= 0, F.lit(False)) & ~is_cancellation()


def total_amount() -> Column:
    return F.col("Quantity") * F.col("UnitPrice")


def standard_country(c: Column) -> Column:
    name = title_case(F.trim(c))
    fixed = F.when(F.lit(False), name)
    for old, new in COUNTRY_NAMES.items():
        fixed = fixed.when(name == old, F.lit(new))
    return fixed.otherwise(name)


def calendar(lines: DataFrame) -> DataFrame:
    """Calendar columns of each line's invoice date."""
    at = F.col("InvoiceDate")
    return lines.withColumns(
        {
            "Year": F.year(at).cast("smallint"),
            "Month": F.month(at).cast("tinyint"),
            "DayOfWeek": F.date_format(at, "EEEE"),
            "Hour": F.hour(at).cast("tinyint"),
            "Quarter": F.quarter(at).cast("tinyint"),
            "YearMonth": year_month(at),
            "DateKey": F.date_format(at, "yyyy-MM-dd"),
        }
    )


def customer_lines(raw: DataFrame) -> DataFrame:
    """Every line of a known customer once."""
    return raw.select(*LINE_COLUMNS).na.drop(subset=["CustomerID"]).dropDuplicates()


def fact_of(lines: DataFrame) -> DataFrame:
    """The fact population of ``customer_lines``, without calendar columns."""
    return lines.filter(~has_bad_price()).withColumns(
        {
            "IsCancellation": is_cancellation().cast("tinyint"),
            "IsReturn": is_return().cast("tinyint"),
            "TotalAmount": total_amount(),
            "Country": standard_country(F.col("Country")),
        }
    )


def fact_transactions_of(lines: DataFrame) -> DataFrame:
    """The fact table of ``customer_lines``."""
    return calendar(fact_of(lines).na.fill({"Description": UNKNOWN}))


def fact_transactions(raw: DataFrame) -> DataFrame:
    return fact_transactions_of(customer_lines(raw))


def is_sale() -> Column:
    return ~is_cancellation() & (F.col("Quantity") > 0) & (F.col("UnitPrice") > 0)


def sales_of(lines: DataFrame) -> DataFrame:
    """The sales population of ``customer_lines``."""
    return lines.filter(is_sale()).withColumn("TotalAmount", total_amount())


def clean_sales(raw: DataFrame) -> DataFrame:
    return sales_of(customer_lines(raw))


def lines_with_cancellations(raw: DataFrame) -> DataFrame:
    return (
        raw.select(*LINE_COLUMNS)
        .na.drop(subset=["CustomerID"])
        .dropDuplicates()
        .withColumns(
            {"TotalAmount": total_amount(), "IsCancelled": is_cancellation().cast("tinyint")}
        )
    )


def etl_audit(raw: DataFrame) -> DataFrame:
    """What each cleaning step found, from one pass over the distinct lines and their counts.

    Cancellations and returns are counted before copies are removed, missing customers and bad
    prices after.
    """
    distinct = raw.groupBy(*LINE_COLUMNS).agg(F.count(F.lit(1)).alias("copies"))
    copies = F.col("copies")
    known = F.col("CustomerID").isNotNull()

    def copies_if(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, copies)), F.lit(0))

    return distinct.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("input_rows"),
        copies_if(is_cancellation()).alias("cancellations"),
        copies_if(is_return()).alias("returns"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).alias("duplicates_removed"),
        F.count_if(~known).alias("null_customers_dropped"),
        F.count_if(known & F.col("Description").isNull()).alias("descriptions_filled"),
        F.count_if(known & has_bad_price()).alias("bad_prices_removed"),
        F.count_if(known & ~has_bad_price()).alias("final_rows"),
    )


def schema_check(df: DataFrame, expected: Sequence[str] = LINE_COLUMNS) -> DataFrame:
    """column, status (ok, missing, extra), whether the order is the expected one, and the number
    of missing values. For a CSV file pass ``read_text_csv``: the header as it is, nothing typed."""
    found = df.columns
    status = {c: "ok" if c in found else "missing" for c in expected}
    status |= {c: "extra" for c in found if c not in expected}
    in_order = [c for c in found if c in expected] == [c for c in expected if c in found]
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in found])
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(s).alias("status"),
            F.lit(in_order).alias("order_ok"),
            (F.col(c) if c in found else F.lit(None).cast("bigint")).alias("nulls"),
        )
        for c, s in status.items()
    ]
    return nulls.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
