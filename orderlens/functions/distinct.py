"""Counts of distinct values in several columns."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(df: DataFrame, key: str, columns: Mapping[str, Column | str], in_buckets: bool = False) -> DataFrame:
    """One row per ``key`` with the number of distinct values of each column.

    One aggregation over several distinct columns copies every row for each of them and shuffles the
    copies. Rows that are stored in buckets of ``key`` need none of that: a pass per column groups
    within its bucket, and their join leaves out null keys. Other inputs would be made again by each pass,
    so they take the one aggregation.
    """
    counts = {name: F.countDistinct(c).alias(name) for name, c in columns.items()}
    if not in_buckets:
        return df.groupBy(key).agg(*counts.values())
    return reduce(lambda a, b: a.join(b, key), [df.groupBy(key).agg(c) for c in counts.values()])
