"""Positions and running totals in a global order, in one shuffle and without a one-task window.

A window without ``partitionBy`` moves every row to one task. Here the order is cut into buckets at split
points that a quantile sketch gives (partial sketches merge, so this is one pass with no shuffle of
rows). A value that fills several buckets by itself is split again by the column that breaks ties. The
split points are constants of the plan, so a row's bucket is a plain expression of the row: it is the
same in every attempt of a task, and nothing has to be stored. Sums per bucket, a row each, reach the
driver and come back as constants; the one shuffle brings each bucket together for its own window.
"""

from collections import Counter
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "_order_bucket"

#: A split point: its value, and the tie column's value where the value itself is split.
Cut = tuple[object, object | None]


def split_points(df: DataFrame, value: str, tie: str, buckets: int, descending: bool = False) -> list[Cut]:
    """Split points in order, one fewer than there are buckets at most."""
    shares = [F.lit(i / buckets) for i in range(1, buckets)]
    if not shares:
        return []
    found = df.agg(F.percentile_approx(value, F.array(*shares), F.lit(100 * buckets)).alias("cuts")).first()["cuts"] or []
    times = Counter(found)
    heavy = [v for v, n in times.items() if n > 1]
    inner: dict[object, list] = {}
    if heavy:
        ties = df.filter(F.col(value).isin(heavy)).groupBy(F.col(value).alias("v"))
        most = max(times.values())
        for row in ties.agg(F.percentile_approx(tie, F.array(*[F.lit(i / most) for i in range(1, most)]), F.lit(100 * most)).alias("cuts")).collect():
            inner[row["v"]] = sorted(set(row["cuts"]))
    cuts: list[Cut] = []
    for v in sorted(times, reverse=descending):
        cuts += [(v, None), *((v, t) for t in inner.get(v, []))]
    return cuts


def bucket_of(value: str, tie: str, cuts: Sequence[Cut], kind: str, descending: bool = False) -> Column:
    """How many split points lie at or before a row; a tree of comparisons."""

    def before(cut: Cut) -> Column:
        v = F.lit(cut[0]).cast(kind)
        ahead = F.col(value) > v if descending else F.col(value) < v
        return ahead if cut[1] is None else ahead | ((F.col(value) == v) & (F.col(tie) < F.lit(cut[1])))

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(before(cuts[middle]), tree(low, middle)).otherwise(tree(middle + 1, high))

    return tree(0, len(cuts))


def running_totals(
    df: DataFrame,
    value: str,
    tie: str,
    totals: Mapping[str, Column],
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Add, per name in ``totals``, the sum of that column over all rows up to this one.

    Rows go by ``value``, equal ones by rising ``tie``, a whole number that no two rows of one value
    share; nulls come last. Totals are whole numbers or decimals; a total of ``lit(1)`` is the row
    number. There are as many ``buckets`` as shuffle partitions unless stated. ``df`` must give the same
    rows each time it is computed: two passes find split points and offsets when this is called.
    """
    count = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(df.dtypes)[value]
    cuts = split_points(df, value, tie, count, descending)
    own = {t: f"_own_{t}" for t in totals}
    placed = df.select("*", *[c.alias(own[t]) for t, c in totals.items()], bucket_of(value, tie, cuts, kind, descending).alias(_BUCKET))

    sums = placed.groupBy(_BUCKET).agg(*[F.sum(own[t]).alias(t) for t in totals])
    by_bucket = {row[_BUCKET]: row for row in sums.collect()}
    kinds = dict(sums.dtypes)

    def offset(total: str) -> Column:
        before, offsets = Decimal(0) if kinds[total].startswith("decimal") else 0, []
        for bucket in range(len(cuts) + 1):
            offsets.append(before)
            before += (by_bucket[bucket][total] or 0) if bucket in by_bucket else 0
        return F.element_at(F.array(*[F.lit(str(x)).cast(kinds[total]) for x in offsets]), F.col(_BUCKET) + 1)

    rank = F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)
    here = Window.partitionBy(_BUCKET).orderBy(rank, F.asc_nulls_last(tie)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.withColumns({t: F.sum(own[t]).over(here) for t in totals}).select(
        *df.columns, *[(F.col(t) + offset(t)).alias(t) for t in totals]
    )
