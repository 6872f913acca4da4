"""Recency, frequency, monetary value: base, quintile scores, segments."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.durable import durable
from orderlens.functions.numeric import EXACT, exact_mean, exact_sum, percent
from orderlens.functions.ordering import running_totals
from orderlens.functions.times import whole_days
from orderlens.operators.features import reference_date

QUINTILE_EDGES = (0.2, 0.4, 0.6, 0.8)


def rfm_base(sales: DataFrame) -> DataFrame:
    """The customer rows are written once; the last purchase of all is read from them."""
    customers = durable(
        sales.groupBy("CustomerID").agg(
            F.max("InvoiceDate").alias("_last"),
            F.countDistinct("InvoiceNo").alias("Frequency"),
            exact_sum("TotalAmount").alias("Monetary"),
        )
    )
    recency = whole_days(F.col("_last"), reference_date(customers, "_last"))
    return customers.select("CustomerID", recency.alias("Recency"), "Frequency", "Monetary")


def rank_quintile(position: Column, rows: Column) -> Column:
    """Equal-frequency fifth (1 to 5) of a row number; the edges are interpolated positions."""
    return F.greatest(
        F.lit(1), F.floor((5 * (position - 1) + rows - 2) / F.greatest(rows - 1, F.lit(1)))
    ).cast("int")


def rfm_scores(rfm: DataFrame) -> DataFrame:
    """Scores 1 (worst) to 5 (best).

    Frequency and Monetary are ranked each in a global order; ties go by customer id. Recency is cut
    at interpolated quantiles of its values (whole days, so few); equal edges collapse and leave a
    score unused.
    """
    by_customer = rfm.withColumn("_money", F.col("Monetary").cast(EXACT))
    for metric in ("Frequency", "_money"):
        by_customer = running_totals(by_customer, metric, "CustomerID", {f"_place{metric}": F.lit(1)})
    facts = (
        rfm.agg(
            F.count(F.lit(1)).alias("rows"),
            F.percentile("Recency", F.array(*[F.lit(e) for e in QUINTILE_EDGES])).alias("edges"),
        )
        .select(F.struct("rows", "edges"))
        .scalar()
    )
    above = sum(
        ((F.col("Recency") > facts["edges"][i]).cast("int") for i in range(len(QUINTILE_EDGES))),
        F.lit(0),
    )
    scores = by_customer.select(
        *rfm.columns,
        (F.lit(5) - above).alias("R_Score"),
        rank_quintile(F.col("_placeFrequency"), facts["rows"]).alias("F_Score"),
        rank_quintile(F.col("_place_money"), facts["rows"]).alias("M_Score"),
    )
    each = [F.col(c) for c in ("R_Score", "F_Score", "M_Score")]
    return scores.select(
        "*",
        F.concat(*[c.cast("string") for c in each]).alias("RFM_Score"),
        (each[0] + each[1] + each[2]).alias("RFM_Total"),
    )


# Segments in the order they are tried, each with its range of R, F and M scores.
# "Cant Lose Them" lies wholly inside "At Risk" and so never applies; it is kept for parity.
SEGMENT_RANGES = [
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (3, 5)),
    ("New Customers", (4, 5), (1, 2), (1, 5)),
    ("Potential Loyalists", (3, 5), (1, 5), (2, 5)),
    ("Promising", (3, 5), (1, 2), (1, 2)),
    ("Need Attention", (3, 3), (3, 3), (1, 5)),
    ("At Risk", (1, 2), (3, 5), (3, 5)),
    ("Cant Lose Them", (1, 2), (4, 5), (4, 5)),
    ("Lost", (1, 2), (1, 2), (1, 5)),
    ("Hibernating", (1, 2), (2, 5), (1, 5)),
]
OTHER_SEGMENT = "About to Sleep"


def segment_of(r: Column, f: Column, m: Column) -> Column:
    """Name of the first range that holds the three scores."""
    named = [
        F.when(r.between(*rs) & f.between(*fs) & m.between(*ms), F.lit(name))
        for name, rs, fs, ms in SEGMENT_RANGES
    ]
    return F.coalesce(*named, F.lit(OTHER_SEGMENT))


def rfm_segments(scores: DataFrame) -> DataFrame:
    return scores.withColumn(
        "Segment", segment_of(F.col("R_Score"), F.col("F_Score"), F.col("M_Score"))
    )


def segments_of_sales(sales: DataFrame) -> DataFrame:
    return rfm_segments(rfm_scores(rfm_base(sales)))


def rfm_segment_summary(segments: DataFrame) -> DataFrame:
    return (
        segments.groupBy("Segment")
        .agg(
            F.count(F.lit(1)).alias("Count"),
            F.try_divide(F.sum("Recency").cast("double"), F.count("Recency").cast("double")).alias(
                "Avg_Recency"
            ),
            F.try_divide(
                F.sum("Frequency").cast("double"), F.count("Frequency").cast("double")
            ).alias("Avg_Frequency"),
            exact_mean("Monetary").alias("Avg_Monetary"),
        )
        .orderBy(F.desc("Count"), "Segment")
    )


def rfm_highlights(segments: DataFrame) -> DataFrame:
    champion = F.col("Segment") == "Champions"
    revenue = exact_sum(F.when(champion, F.col("Monetary")))
    return segments.agg(
        F.count_if(champion).alias("champions"),
        F.coalesce(revenue, F.lit(0.0)).alias("champion_revenue"),
        F.coalesce(percent(revenue, exact_sum("Monetary")), F.lit(0.0)).alias("champion_pct"),
        F.count_if(F.col("Segment").isin("At Risk", "Cant Lose Them")).alias("at_risk"),
    )


def segment_revenue(segments: DataFrame) -> DataFrame:
    return (
        segments.groupBy("Segment")
        .agg(F.count(F.lit(1)).alias("count"), exact_sum("Monetary").alias("revenue"))
        .orderBy(F.desc("revenue"), "Segment")
    )
