"""Date and time expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_MONTH = 30.44


# Layouts of dates in order files besides ISO ones.
LAYOUTS = ["M/d/yyyy H:mm[:ss]", "M/d/yyyy"]


def parse_invoice_date(c: Column) -> Column:
    """ISO dates and times, or month first with or without seconds or time; else null."""
    return F.coalesce(F.try_to_timestamp(c), *[F.try_to_timestamp(c, F.lit(x)) for x in LAYOUTS])


def whole_days(start: Column, end: Column) -> Column:
    """Full 24-hour spans between two instants (``datediff`` would count calendar days)."""
    return F.timestamp_diff("DAY", start, end)


def year_month(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM")


def day_after(c: Column) -> Column:
    return c + F.make_dt_interval(days=F.lit(1))
