"""Monthly acquisition cohorts; input is the sales population."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.numeric import percent
from orderlens.operators.customers import active_months


def _months_apart(later: str, earlier: str):
    first_day = [F.to_date(F.concat(F.col(c), F.lit("-01"))) for c in (later, earlier)]
    return F.months_between(*first_day).cast("int")


def cohort_counts(sales: DataFrame) -> DataFrame:
    return (
        active_months(sales)
        .groupBy(F.col("FirstMonth").alias("CohortMonth"), F.col("YearMonth").alias("OrderMonth"))
        .agg(F.count(F.lit(1)).alias("n_customers"))
        .withColumn("CohortIndex", _months_apart("OrderMonth", "CohortMonth"))
        .select("CohortMonth", "OrderMonth", "CohortIndex", "n_customers")
    )


def cohort_retention(
    sales: DataFrame, rows: int | None = None, cols: int | None = None
) -> DataFrame:
    """Long form; ``rows`` keeps the first cohorts, ``cols`` the first months since purchase."""
    cohort = Window.partitionBy("CohortMonth")
    size = F.max(F.when(F.col("CohortIndex") == 0, F.col("n_customers"))).over(cohort)
    retention = cohort_counts(sales).select(
        "CohortMonth", "CohortIndex", percent("n_customers", size).alias("retention_pct")
    )
    if cols is not None:
        retention = retention.filter(F.col("CohortIndex") < cols)
    if rows is not None:
        # One row per cohort month, so the ranking is no longer than the calendar.
        first = retention.select("CohortMonth").distinct().orderBy("CohortMonth").limit(rows)
        retention = retention.join(F.broadcast(first), "CohortMonth", "left_semi")
    return retention


def cohort_matrix(sales: DataFrame, rows: int | None = None, cols: int | None = None) -> DataFrame:
    """Wide form of the retention table, one column per month since purchase; all by default.

    Only the number of the last month reaches the driver, to name the columns.
    """
    retention = cohort_retention(sales, rows, cols)
    if cols is None:
        last = retention.agg(F.max("CohortIndex")).first()[0]
        cols = 0 if last is None else last + 1
    return retention.groupBy("CohortMonth").pivot("CohortIndex", list(range(cols))).agg(F.first("retention_pct"))
