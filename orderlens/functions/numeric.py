"""Numeric expressions that keep their result independent of row order and partitioning."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Double sums depend on the order of the rows; sums of decimals do not, so totals, ranks built on
# them and re-run tasks always agree. Money has four decimals; pass a larger scale for finer values.
MONEY_SCALE = 4
EXACT = f"decimal(28,{MONEY_SCALE})"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def counted(c: Column | str) -> Column:
    """The value, or null where it is missing or not a number."""
    c = as_column(c)
    return F.when(~F.isnan(c.cast("double")), c)


def exact_sum(c: Column | str, scale: int = MONEY_SCALE) -> Column:
    """Sum of the values rounded to ``scale`` decimals; not-a-number counts as missing."""
    return F.sum(counted(c).cast(f"decimal({24 + scale},{scale})")).cast("double")


def exact_mean(c: Column | str, scale: int = MONEY_SCALE) -> Column:
    return F.try_divide(exact_sum(c, scale), F.count(counted(c)).cast("double"))


def percent(part: Column | str, whole: Column | str) -> Column:
    return F.try_divide(as_column(part).cast("double") * 100.0, as_column(whole).cast("double"))


def sample_skewness(c: Column | str) -> Column:
    """Bias-corrected skewness; null below three values."""
    c = as_column(c)
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(c: Column | str) -> Column:
    """Bias-corrected excess kurtosis; null below four values."""
    c = as_column(c)
    n = F.count(c).cast("double")
    return F.when(
        n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6)
    )
