"""Profile of the raw lines."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.durable import stored
from orderlens.functions.numeric import percent, sample_kurtosis, sample_skewness
from orderlens.functions.quantiles import quantile_limits
from orderlens.functions.times import whole_days, year_month
from orderlens.operators.cleaning import is_cancellation
from orderlens.schema import DUPLICATE_KEYS, LINE_COLUMNS, NUMERIC_COLUMNS, TEXT_COLUMNS


def column_values(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, value (as text), n: how often each value occurs in each column.

    One scan; each column's repeated values collapse on the map side, and a column's values are
    spread over all tasks because the value is part of the shuffle key.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        raw.select(F.explode(pairs).alias("pair"))
        .select("pair.column", "pair.value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def profile_columns(raw: DataFrame, columns: Sequence[str] = LINE_COLUMNS) -> DataFrame:
    types = dict(raw.dtypes)
    dtype = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    present = F.col("value").isNotNull()
    per_column = (
        column_values(raw, columns)
        .groupBy("column")
        .agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("non_null"),
            F.count("value").alias("n_distinct"),
        )
    )
    share = F.try_divide(F.col("n_distinct").cast("double"), F.col("rows").cast("double"))
    return per_column.select(
        "column",
        dtype[F.col("column")].alias("dtype"),
        "non_null",
        (F.col("rows") - F.col("non_null")).alias("nulls"),
        percent(F.col("rows") - F.col("non_null"), "rows").alias("null_pct"),
        "n_distinct",
        F.when(share > 0.5, "HIGH").when(share > 0.05, "MEDIUM").otherwise("LOW").alias(
            "cardinality"
        ),
    )


def missing_overall(raw: DataFrame, columns: Sequence[str] = LINE_COLUMNS) -> DataFrame:
    missing = sum((F.count_if(F.col(c).isNull()) for c in columns), F.lit(0))
    cells = F.count(F.lit(1)) * F.lit(len(columns))
    return raw.agg(missing.alias("missing_cells"), cells.alias("total_cells")).withColumn(
        "pct", percent("missing_cells", "total_cells")
    )


def duplicate_report(raw: DataFrame, keys: Sequence[str] = DUPLICATE_KEYS) -> DataFrame:
    """Surplus rows when comparing all columns, and when comparing ``keys`` only."""
    by_line = raw.groupBy(*LINE_COLUMNS).agg(F.count(F.lit(1)).alias("copies"))
    by_key = by_line.groupBy(*keys).agg(
        F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("variants")
    )
    return by_key.agg(
        F.coalesce(F.sum(F.col("rows") - F.col("variants")), F.lit(0)).alias("exact_dups"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("partial_dups"),
        F.sum("rows").alias("rows"),
    ).select(
        "exact_dups",
        percent("exact_dups", "rows").alias("exact_pct"),
        "partial_dups",
        (F.col("partial_dups") - F.col("exact_dups")).alias("extra"),
    )


def numeric_describe(raw: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Moments and quartiles; the columns are written once for the passes of the quartiles."""
    raw = stored(raw.select(*columns))

    def moments_of(c: str):
        value = F.col(c).cast("double")
        quarters = quantile_limits(raw, c, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
        return F.struct(
            F.lit(c).alias("column"),
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev(value).alias("std"),
            F.min(value).alias("min"),
            *[q.alias(name) for name, q in quarters.items()],
            F.max(value).alias("max"),
            sample_skewness(value).alias("skew"),
            sample_kurtosis(value).alias("kurtosis"),
        )

    moments = raw.agg(F.array(*[moments_of(c) for c in columns]).alias("m")).select(F.explode("m").alias("m")).select("m.*")
    return moments.select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max", "skew", "kurtosis"
    )


def anomaly_flags(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count_if(F.col("Quantity") < 0).alias("neg_qty"),
        F.count_if(F.col("Quantity") == 0).alias("zero_qty"),
        F.count_if(F.col("UnitPrice") < 0).alias("neg_price"),
        F.count_if(F.col("UnitPrice") == 0).alias("zero_price"),
    )


def top_values(raw: DataFrame, columns: Sequence[str] = TEXT_COLUMNS, k: int = 10) -> DataFrame:
    """The k most frequent values of each text column, ties by value.

    The rank filter is applied on the map side first, so a column with very many values sends
    at most k rows per task to the final ranking.
    """
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    rows = raw.agg(F.count(F.lit(1))).scalar()
    return (
        column_values(raw, columns)
        .filter(F.col("value").isNotNull())
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("column", "rank", "value", "n", percent("n", rows).alias("pct"))
    )


def cancellation_share(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count_if(is_cancellation()).alias("n"),
        percent(F.count_if(is_cancellation()), F.count(F.lit(1))).alias("pct"),
    )


def country_dominance(raw: DataFrame) -> DataFrame:
    by_country = raw.groupBy("Country").agg(F.count(F.lit(1)).alias("n"))
    total = by_country.agg(
        F.count("Country").alias("n_countries"), F.sum("n").alias("rows")
    ).select(F.struct("n_countries", "rows")).scalar()
    return (
        by_country.filter(F.col("Country").isNotNull())
        .orderBy(F.desc("n"), "Country")
        .limit(1)
        .select(
            total["n_countries"].alias("n_countries"),
            F.col("Country").alias("country"),
            "n",
            percent("n", total["rows"]).alias("pct"),
        )
    )


def date_range(raw: DataFrame) -> DataFrame:
    days = whole_days(F.col("first"), F.col("last"))
    return raw.agg(
        F.min("InvoiceDate").alias("first"), F.max("InvoiceDate").alias("last")
    ).select(
        "first", "last", days.alias("days"), F.floor(days / 30).cast("bigint").alias("months")
    )


def monthly_volume(raw: DataFrame) -> DataFrame:
    return (
        raw.filter(F.col("InvoiceDate").isNotNull())
        .groupBy(year_month("InvoiceDate").alias("YearMonth"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def first_rows(raw: DataFrame, k: int = 5) -> DataFrame:
    """A look at the data; the order is stated because files have none in Spark."""
    return raw.select(*LINE_COLUMNS).orderBy(*LINE_COLUMNS).limit(k)
