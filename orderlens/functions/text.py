"""Text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(c: Column) -> Column:
    """Capital after every non-letter, not only after blanks as ``initcap`` does."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    capital = F.transform(
        runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.right(run, F.length(run) - 1))
    )
    return F.array_join(capital, "")
