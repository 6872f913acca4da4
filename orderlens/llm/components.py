"""Connected components of a link table, by smallest id."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.tables import drop_stored, stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) of all ids in ``links`` (a, b): the smallest id that links reach.

    Each round every id takes the smallest label around it and then the label of that label, so
    the number of rounds grows with the logarithm of the longest chain. Labels are written each
    round; a hot id only ever meets one row per neighbour, and minima combine before the shuffle.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.where("a != b").distinct())
    labels = stored(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component")).select("id", F.least("id", "component").alias("component")))
    while True:
        around = edges.join(labels, edges.b == labels.id).groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        nearer = labels.join(around, "id").select("id", "component", F.least("component", "near").alias("near"))
        jump = labels.select(F.col("id").alias("near"), F.col("component").alias("far"))
        step = nearer.join(jump, "near").select("id", F.least("near", "far").alias("next"), "component")
        step = stored(step)
        changed = step.where("next != component").limit(1).count()
        drop_stored(labels)
        labels = step.select("id", F.col("next").alias("component"))
        if not changed:
            return labels
