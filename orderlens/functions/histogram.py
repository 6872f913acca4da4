"""Equal-width histograms."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(
    df: DataFrame,
    value: str,
    bins: int,
    clip: Column | None = None,
    keep_below: Column | None = None,
    weight: str | None = None,
) -> DataFrame:
    """bin, lo, hi, n with every bin present; the largest value falls in the last bin.

    ``clip`` moves larger values down to it, ``keep_below`` drops larger values, ``weight``
    counts a row several times.
    """
    x = F.col(value).cast("double")
    if clip is not None:
        x = F.least(x, clip.cast("double"))
    points = df.select(
        x.alias("x"), (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("w")
    ).filter(F.col("x").isNotNull())
    if keep_below is not None:
        points = points.filter(F.col("x") <= keep_below)

    edges = bin_edges(points, "x", bins)
    edge = edges.select(F.struct("first", "width")).scalar()
    counts = (
        points.groupBy(bin_index(F.col("x"), edge["first"], edge["width"], bins).alias("bin"))
        .agg(F.sum("w").alias("n"))
    )
    frame = edges.filter(F.col("width").isNotNull()).select(
        "first", "width", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("first") + F.col("bin") * F.col("width")).alias("lo"),
        (F.col("first") + (F.col("bin") + 1) * F.col("width")).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def bin_edges(df: DataFrame, value: str, bins: int) -> DataFrame:
    """One row: lower edge of the first bin and bin width; a single value gets width 1 overall."""
    low, high = F.min(value), F.max(value)
    flat = low == high
    return df.agg(
        F.when(flat, low - 0.5).otherwise(low).cast("double").alias("first"),
        (F.when(flat, F.lit(1.0)).otherwise(high - low) / F.lit(float(bins))).alias("width"),
    )


def bin_index(x: Column, first: Column, width: Column, bins: int) -> Column:
    return F.least(F.floor((x - first) / width), F.lit(bins - 1)).cast("int")
