"""Product pairs bought together; input is the sales population."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Names of one invoice that meet in one group of the pair join.
BLOCK_NAMES = 256
#: Commonest names whose pairs give a first bound for the k-th best pair.
BOUND_NAMES = 64


def sampled_invoices(sales: DataFrame, sample: int) -> DataFrame:
    """Lines of exactly ``sample`` invoices (all, if there are fewer): those of the least hash.

    A sketch of the number of invoices bounds the hashes that are ordered to about twice the sample.
    """
    invoices = sales.filter(F.col("InvoiceNo").isNotNull()).select("InvoiceNo").withColumn("hash", F.md5("InvoiceNo"))
    number = invoices.agg(F.greatest(F.approx_count_distinct("InvoiceNo", 0.02), F.lit(1))).scalar()
    # The first 52 bits of the hash as a number; its share of all is that of invoices below it.
    part = F.conv(F.substring("hash", 1, 13), 16, 10).cast("double") / float(1 << 52)
    near = invoices.filter(part * number < 2.0 * sample + 200.0).distinct()
    picked = near.orderBy("hash", "InvoiceNo").limit(sample).select("InvoiceNo")
    return sales.join(picked, "InvoiceNo", "left_semi")


def basket_items(sales: DataFrame, max_items: int | None = None, sample: int | None = None) -> DataFrame:
    """Distinct (InvoiceNo, Description); ``max_items`` keeps the alphabetically first of an invoice.

    ``sample`` is the number of invoices to use, chosen by hash.

    The rank filter of ``max_items`` runs in every task before the shuffle by invoice.
    """
    lines = sales.filter(F.col("InvoiceNo").isNotNull() & F.col("Description").isNotNull())
    if sample is not None:
        lines = sampled_invoices(lines, sample)
    names = lines.select("InvoiceNo", "Description").distinct()
    if max_items is None:
        return names
    alphabetical = Window.partitionBy("InvoiceNo").orderBy("Description")
    return names.withColumn("place", F.row_number().over(alphabetical)).filter(F.col("place") <= max_items).drop("place")


def count_pairs(items: DataFrame) -> DataFrame:
    """item_a < item_b and the number of baskets of ``items`` (InvoiceNo, Description) with both.

    The names of an invoice are hashed to blocks and two blocks meet per group, so an invoice of any
    size is spread over many groups and no list of names is built.
    """
    sizes = items.groupBy("InvoiceNo").agg(F.ceil(F.count(F.lit(1)) / BLOCK_NAMES).cast("int").alias("blocks"))
    dealt = items.join(sizes, "InvoiceNo").withColumn("own", F.pmod(F.xxhash64("Description"), F.col("blocks")).cast("int"))
    meets = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    spread = dealt.select("InvoiceNo", "Description", "own", meets).select(
        "InvoiceNo", "Description", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )
    a, b = spread.alias("a"), spread.alias("b")
    same_group = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("InvoiceNo", "low", "high")]
    once = (F.col("a.low") == F.col("a.high")) | (F.col("a.own") != F.col("b.own"))
    pairs = a.join(b, [*same_group, F.col("a.Description") < F.col("b.Description"), once])
    return pairs.groupBy(F.col("a.Description").alias("item_a"), F.col("b.Description").alias("item_b")).agg(
        F.count(F.lit(1)).alias("n")
    )


def pair_counts(sales: DataFrame, max_items: int | None = None, sample: int | None = None) -> DataFrame:
    return count_pairs(basket_items(sales, max_items, sample))


def best(pairs: DataFrame, k: int) -> DataFrame:
    return pairs.orderBy(F.desc("n"), "item_a", "item_b").limit(k)


def least_count(counts: DataFrame, items: DataFrame, k: int) -> Column:
    """A bound that the k-th best pair reaches: that of the pairs among the commonest names, or 0."""
    common = counts.orderBy(F.desc("n_name"), "Description").limit(BOUND_NAMES).select("Description")
    top = best(count_pairs(items.join(F.broadcast(common), "Description")), k)
    return top.agg(F.when(F.count(F.lit(1)) == k, F.min("n")).otherwise(0)).scalar()


def product_pairs(
    sales: DataFrame, k: int = 20, max_items: int | None = None, sample: int | None = None
) -> DataFrame:
    """The k commonest pairs over all items of all baskets, unless ``max_items`` or ``sample`` says less.

    A pair is in no more baskets than its rarer name, so names below the bound of the k-th pair are
    left out before any pair is made; the result stays exact.
    """
    items = basket_items(sales, max_items, sample)
    counts = items.groupBy("Description").agg(F.count(F.lit(1)).alias("n_name"))
    frequent = counts.filter(F.col("n_name") >= least_count(counts, items, k)).select("Description")
    return best(count_pairs(items.join(frequent, "Description")), k)
