"""K-means customer segments on scaled log RFM, and their two-dimensional projection.

The elbow needs nine cluster counts with ten restarts each. All ninety models move together: one
pass over the customers assigns each of them in every model, adds up per task, and only the sums
(a row per centre) are shuffled and brought to the driver. All customers take part in the seeding. Converged models drop out of the pass.
"""

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.durable import durable
from orderlens.functions.numeric import exact_mean

MEASURES = ["Recency", "Frequency", "Monetary"]
SCALED = [f"{c}_scaled" for c in MEASURES]
ELBOW_RANGE = range(2, 11)
CLUSTERS = 4
SEED = 42
RESTARTS = 10
MAX_ITERATIONS = 300
TOLERANCE = 1e-4

# Cluster names by falling mean revenue.
CLUSTER_LABELS = ["Champions", "Loyal Customers", "At Risk", "New/Casual"]


def rfm_scaled(rfm: DataFrame) -> DataFrame:
    """log1p, then centred and divided by the population standard deviation."""
    logs = rfm.select("CustomerID", *[F.log1p(c).alias(c) for c in MEASURES])
    stats = logs.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in MEASURES],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in MEASURES],
    )
    one = stats.select(F.struct(*stats.columns)).scalar()

    def scaled(c: str) -> Column:
        # A constant measure is centred only.
        spread = F.when(one[f"{c}_std"] == 0, F.lit(1.0)).otherwise(one[f"{c}_std"])
        return (F.col(c) - one[f"{c}_mean"]) / spread

    return logs.select("CustomerID", *[scaled(c).alias(s) for c, s in zip(MEASURES, SCALED)])


def scaled_points(rfm: DataFrame) -> DataFrame:
    """The RFM columns with their scaled values, written once because fitting reads them often."""
    return durable(rfm.join(rfm_scaled(rfm), "CustomerID").select("CustomerID", *MEASURES, *SCALED))


def uniform(ids: np.ndarray, restart: int, step: int) -> np.ndarray:
    """A number in (0, 1) per customer, restart and step, from plain integer arithmetic."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((SEED + restart) * 1_000_003 + step)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0**53 + 2.0**-54


def seed_centres(points: DataFrame, k: int, restarts: int) -> list[np.ndarray]:
    """k-means++ over all rows, for all restarts together: one pass per centre.

    The row with the least -ln(u) / d2 is a draw with probability by d2, the squared distance to the
    nearest centre so far; each task sends its best row per restart.
    """
    centres = [np.empty((0, len(SCALED))) for _ in range(restarts)]
    for step in range(k):

        def draw(batches: Iterator[pd.DataFrame], step=step, centres=centres) -> Iterator[pd.DataFrame]:
            best: dict[int, tuple[float, int, list[float]]] = {}
            for batch in batches:
                ids, x = batch["CustomerID"].to_numpy(), batch[SCALED].to_numpy(dtype=float)
                if not len(ids):
                    continue
                for r, chosen in enumerate(centres):
                    near = ((x[:, None, :] - chosen[None]) ** 2).sum(axis=2).min(axis=1) if step else 1.0
                    # Rows on a centre are drawn only when no others are left.
                    key = -np.log(uniform(ids, r, step)) / np.maximum(near, 1e-300)
                    at = np.lexsort((ids, key))[0]
                    best[r] = min(best.get(r, (np.inf, 0, [])), (float(key[at]), int(ids[at]), x[at].tolist()))
            yield pd.DataFrame([(r, *b) for r, b in best.items()], columns=["restart", "draw", "id", "point"])

        drawn = points.select("CustomerID", *SCALED).mapInPandas(draw, "restart int, draw double, id long, point array<double>")
        first = drawn.groupBy("restart").agg(F.min_by("point", F.struct("draw", "id")).alias("point")).collect()
        for row in first:
            centres[row["restart"]] = np.vstack([centres[row["restart"]], row["point"]])
    return centres


def _sums_per_centre(models: Sequence[np.ndarray]):
    """Task side: per model and centre the count, coordinate sums and squared distances."""
    sizes = [len(m) for m in models]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    stacked = np.vstack(models)
    squares = (stacked**2).sum(axis=1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((len(stacked), 2 + stacked.shape[1]))
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            distance = (x**2).sum(axis=1)[:, None] - 2 * x @ stacked.T + squares
            for start, size in zip(starts, sizes):
                part = distance[:, start : start + size]
                label = part.argmin(axis=1)
                cost = np.maximum(part[np.arange(len(x)), label], 0.0)
                columns = [None, cost, *x.T]
                for i, column in enumerate(columns):
                    totals[start : start + size, i] += np.bincount(label, column, size)
        used = np.flatnonzero(totals[:, 0])
        yield pd.DataFrame({"centre": used, "sums": list(totals[used])})

    return run


def fit_models(
    points: DataFrame, ks: Iterable[int], restarts: int = RESTARTS
) -> dict[int, tuple[float, np.ndarray]]:
    """Per k the least cost and its centres over all restarts."""
    ks = list(ks)
    values = points.select("CustomerID", *SCALED).persist()
    try:
        # A model of fewer clusters starts from the first centres of its restart.
        seeds = seed_centres(values, max(ks), restarts)
        active = {(k, r): seeds[r][:k] for k in ks for r in range(restarts)}
        done: dict[tuple[int, int], tuple[float, np.ndarray]] = {}
        for iteration in range(MAX_ITERATIONS):
            keys, models = list(active), list(active.values())
            sums = (
                values.select(*SCALED)
                .mapInPandas(_sums_per_centre(models), "centre long, sums array<double>")
                .groupBy("centre")
                .agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(2 + len(SCALED))])
                .collect()  # one row per centre
            )
            totals = np.zeros((sum(map(len, models)), 2 + len(SCALED)))
            for row in sums:
                totals[row["centre"]] = row[1:]
            start = 0
            for key, centres in zip(keys, models):
                mine = totals[start : start + len(centres)]
                start += len(centres)
                filled = mine[:, 0] > 0
                moved = centres.copy()
                moved[filled] = mine[filled, 2:] / mine[filled, :1]
                # The scaled columns have variance one, so the tolerance needs no scaling.
                shift = ((moved - centres) ** 2).sum()
                if shift <= TOLERANCE or iteration == MAX_ITERATIONS - 1:
                    done[key] = (float(mine[:, 1].sum()), centres)
                    del active[key]
                else:
                    active[key] = moved
            if not active:
                break
    finally:
        values.unpersist()
    best: dict[int, tuple[float, np.ndarray]] = {}
    for (k, _), fit in sorted(done.items()):
        if k not in best or fit[0] < best[k][0]:
            best[k] = fit
    return best


def kmeans_elbow(
    rfm: DataFrame, ks: Sequence[int] = ELBOW_RANGE, restarts: int = RESTARTS
) -> DataFrame:
    fits = fit_models(scaled_points(rfm), ks, restarts)
    return rfm.sparkSession.createDataFrame(
        [(k, cost) for k, (cost, _) in sorted(fits.items())], "k int, inertia double"
    )


def nearest_centre(centres: np.ndarray) -> Column:
    """Index of the closest centre, as plain column arithmetic."""
    distances = F.array(
        *[
            sum(((F.col(c) - F.lit(float(v))) ** 2 for c, v in zip(SCALED, centre)), F.lit(0.0))
            for centre in centres
        ]
    )
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def kmeans_segments(rfm: DataFrame, k: int = CLUSTERS, restarts: int = RESTARTS) -> DataFrame:
    points = scaled_points(rfm)
    _, centres = fit_models(points, [k], restarts)[k]
    return points.select("CustomerID", *MEASURES, nearest_centre(centres).alias("Cluster"))


def cluster_profiles(segments: DataFrame) -> DataFrame:
    """Means per cluster, named by falling mean revenue; one row per cluster, so few."""
    means = segments.groupBy("Cluster").agg(
        *[F.round(exact_mean(c), 1).alias(f"Avg_{c}") for c in MEASURES],
        F.count(F.lit(1)).alias("Count"),
    )
    place = F.row_number().over(Window.orderBy(F.desc("Avg_Monetary"), "Cluster"))
    names = F.array(*[F.lit(x) for x in CLUSTER_LABELS])
    return means.withColumn("_place", place).select(
        "Cluster",
        F.coalesce(
            F.try_element_at(names, F.col("_place")),
            F.concat(F.lit("Cluster "), F.col("Cluster").cast("string")),
        ).alias("Label"),
        *[f"Avg_{c}" for c in MEASURES],
        "Count",
    )


def kmeans_profiles(rfm: DataFrame, k: int = CLUSTERS, restarts: int = RESTARTS) -> DataFrame:
    return cluster_profiles(kmeans_segments(rfm, k, restarts))


def rfm_pca(rfm: DataFrame) -> DataFrame:
    """Two components per customer and the share of variance each explains.

    The largest loading of a component is positive, so its sign does not depend on the solver.
    """
    assembler = VectorAssembler(inputCols=SCALED, outputCol="features")
    vectors = assembler.transform(scaled_points(rfm))
    model = PCA(k=2, inputCol="features", outputCol="projected").fit(vectors)
    shares = [float(x) for x in model.explainedVariance]
    loadings = model.pc.toArray()
    signs = [float(np.sign(c[np.abs(c).argmax()])) for c in loadings.T]
    xy = vector_to_array("projected")
    return model.transform(vectors).select(
        "CustomerID",
        (xy[0] * signs[0]).alias("PC1"),
        (xy[1] * signs[1]).alias("PC2"),
        F.lit(shares[0]).alias("PC1_ratio"),
        F.lit(shares[1]).alias("PC2_ratio"),
    )
