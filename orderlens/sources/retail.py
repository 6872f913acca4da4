"""Order lines in retail shape, derived from a wholesale star schema.

The source tables are clean; this view plants, by fixed rules on the keys, the defects that
order files have: cancellations, returns, missing customers and names, zero prices, copies,
inconsistent country spelling.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.schema import LINE_COLUMNS


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _padded(c, width: int):
    text = c.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Raw lines plus the source keys and attributes some reports need."""
    lines = read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("pk"),
        F.col("l_quantity").alias("q"),
        F.col("l_extendedprice").alias("ep"),
        F.col("l_discount").alias("discount"),
    )
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ok"), F.col("o_custkey").alias("ck"), "o_orderdate"
    )
    parts = read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("pk"), "p_name", "p_brand", "p_type", "p_retailprice"
    )
    nations = read_table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"
    )
    buyers = (
        read_table(spark, folder, "customer")
        .select(F.col("c_custkey").alias("ck"), "c_nationkey")
        .join(nations, "c_nationkey")
    )
    # Buyers meet orders before the lines do: no shuffle of lines by customer.
    joined = lines.join(orders.join(buyers, "ck"), "ok").join(parts, "pk")

    ok, pk, nk = F.col("ok"), F.col("pk"), F.col("c_nationkey")
    cancelled = ok % 50 == 0
    quantity = (
        F.col("q")
        * F.when(cancelled, -1).otherwise(1)
        * F.when((ok + pk) % 97 == 0, 40).otherwise(1)
    )
    price = F.when((pk % 100 == 1) & (F.col("line") == 7), 0.0).otherwise(
        F.floor(F.col("ep") / F.col("q") * 100) / 100
    )
    started = F.make_dt_interval(
        hours=(6 + ok % 15).cast("int"), mins=(ok * 7 % 60).cast("int")
    )
    # One scan gives both copies of the lines that occur twice.
    copies = F.when((ok % 100).isin(0, 7, 9), 2).otherwise(1)
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).select(
        F.when(cancelled, F.concat(F.lit("C"), ok.cast("string")))
        .otherwise(ok.cast("string"))
        .alias("InvoiceNo"),
        F.concat(_padded(F.substring("p_brand", 7, 10), 2), _padded(pk, 5)).alias("StockCode"),
        F.when(pk % 200 == 0, F.lit(None))
        .when((ok + F.col("line")) % 29 == 0, F.upper("p_name"))
        .otherwise(F.col("p_name"))
        .alias("Description"),
        quantity.cast("bigint").alias("Quantity"),
        (F.col("o_orderdate").cast("timestamp") + started).alias("InvoiceDate"),
        price.cast("double").alias("UnitPrice"),
        F.when(ok % 4 != 1, F.col("ck")).alias("CustomerID"),
        F.when(nk == 0, " EIRE ")
        .when(nk == 1, "rsa")
        .when(nk == 2, "UNITED KINGDOM")
        .otherwise(F.col("n_name"))
        .alias("Country"),
        "discount",
        "p_brand",
        "p_type",
        "p_retailprice",
        "n_regionkey",
        "n_name",
    )


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The eight columns of an order file."""
    return order_lines(spark, folder).select(*LINE_COLUMNS)


def warehouse_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with discount, cost, product category and location.

    Brand and type stand in for category and sub-category, the list price for unit cost.
    """
    regions = read_table(spark, folder, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region")
    )
    return order_lines(spark, folder).join(regions, "n_regionkey").select(
        *LINE_COLUMNS[:-1],
        "discount",
        (F.col("Quantity") * F.col("p_retailprice")).alias("cost"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("sub_category"),
        "region",
        F.col("n_name").alias("country"),
    )
