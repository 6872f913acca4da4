"""Hard-negative mining by exact scores from a residue-number-system matrix product.

Whole-number vectors are reduced modulo several small primes; the residues, centred around 0, are
multiplied as float32 matrices. A prime is small enough that every sum of a product stays below 2**24,
so float32 holds it exactly. The residues of a score modulo all primes give the signed score back by
Chinese remaindering (mixed radix), exactly, as the product of the primes exceeds twice the largest
possible score (bounded by the norms of the two blocks).

1. Anchors meet the rows of their own label: the first ``positives`` others by score.
2. Anchors meet all rows with the score windows of their positives: the first ``negatives`` rows of
   another label whose score lies within a window.

Defined results: null labels, null vec_ids, null vectors and null or non-finite components leave a row
out; exact copies of a row count once; rows that share vec_id but differ are rows of their own, and
none of them is a positive or negative of an anchor with that vec_id; missing components of a shorter
vector count as 0; ties go to the smaller vec_id; windows of negative positive scores are empty; an
empty table gives no rows; other columns are ignored. Scores must stay below 2**61.
"""

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm import vectors
from orderlens.llm.tables import drop_stored, stored

#: Components multiplied at once, at most; float32 holds whole numbers up to EXACT.
CHUNK, EXACT = 4096, 1 << 24
#: Scores of a slice of anchors held at once.
SLICE_SCORES = 1 << 21

POSITIVES = "anchor_id long, anchor_key long, positive_id long, positive_score long"
NEGATIVES = "anchor_id long, anchor_key long, place int, negative_id long, negative_score long"


def primes(dims: int, bound: int) -> list[int]:
    """The largest primes whose centred residues add up exactly over ``dims``, until scores up to ``bound`` are told apart."""
    found, product = [], 1
    p = 2 * isqrt(EXACT // max(1, min(dims, CHUNK))) + 1
    while product <= 2 * bound:
        while any(p % d == 0 for d in range(2, isqrt(p) + 1)):
            p -= 1
        found.append(p)
        product *= p
        p -= 1
    if product >= vectors.LARGEST * 2:
        raise ValueError("scores do not fit: components are too large")
    return found


def norm_bound(v: np.ndarray) -> int:
    """No norm of a row is larger (from float64 sums, with room for their rounding)."""
    return int(np.sqrt((v.astype(np.float64) ** 2).sum(axis=1)).max(initial=0) * (1 + 1e-9)) + 1


class ResidueMatrix:
    """Rows of vectors as float32 residues, one matrix per prime."""

    def __init__(self, v: np.ndarray, moduli: list[int]):
        self.moduli = moduli
        self.parts = []
        for p in moduli:
            r = v % p
            self.parts.append((r - p * (r > p // 2)).astype(np.float32))

    def scores(self, other: "ResidueMatrix", rows: slice) -> np.ndarray:
        """Exact inner products of ``rows`` with all rows of ``other``."""
        found, product = None, 1
        for p, a, b in zip(self.moduli, self.parts, other.parts, strict=True):
            r = np.zeros((len(a[rows]), len(b)), np.int64)
            for at in range(0, a.shape[1], CHUNK):
                r += (a[rows, at : at + CHUNK] @ b[:, at : at + CHUNK].T).astype(np.int64)
            if found is None:
                found = r % p
            else:  # the digit of this prime in mixed radix
                found += product * ((r - found) % p * pow(product, -1, p) % p)
            product *= p
        found[found > product // 2] -= product
        return found


def score_slices(left: pa.Table, right: pa.Table):
    """(row of the anchors, its scores) for every anchor on the left against all rows on the right."""
    a, b = vectors.matrices(left, right)
    moduli = primes(a.shape[1], norm_bound(a) * norm_bound(b))
    anchors, members = ResidueMatrix(a, moduli), ResidueMatrix(b, moduli)
    step = max(1, SLICE_SCORES // len(b))
    for at in range(0, len(a), step):
        yield from enumerate(anchors.scores(members, slice(at, at + step)), at)


def first_by_score(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to the smaller id."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def best_of(found: DataFrame, before: DataFrame | None, by: list[str], score: str, ident: str, k: int) -> DataFrame:
    """The k best rows per ``by`` of this round and the ones before, stored, with their rank."""
    rows = found if before is None else found.union(before.select(found.columns))
    order = Window.partitionBy(*by).orderBy(F.desc(score), ident, "seen")
    best = rows.withColumn("seen", F.monotonically_increasing_id()).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("seen")
    best = stored(best)
    if before is not None:
        drop_stored(before)
    return best


def nearest_of_label(table: DataFrame, is_anchor, k: int, part_rows: int) -> DataFrame:
    """(anchor_id, anchor_key, positive_id, positive_score, rank): the k best other rows of an anchor's label."""

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = vectors.column(right, "vec_id")
        own, keys, least = (left.column(c).to_pylist() for c in ("vec_id", "anchor_key", "least"))
        out: list[list[np.ndarray]] = [[], [], [], []]
        for i, scores in score_slices(left, right):
            usable = np.flatnonzero((ids != own[i]) & (scores >= (least[i] if least[i] is not None else -vectors.LARGEST)))
            best = usable[first_by_score(ids[usable], scores[usable], k)]
            for part, values in zip(out, (np.full(len(best), own[i]), np.full(len(best), keys[i]), ids[best], scores[best]), strict=True):
                part.append(values)
        return vectors.result(POSITIVES, out)

    sizes = table.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_anchor).alias("anchors")).where("anchors > 0")
    pieces = lambda n, size: F.ceil(F.col(n) / size).cast("int")
    sizes = stored(sizes.select("label", pieces("rows", part_rows).alias("parts"), pieces("anchors", vectors.BLOCK_QUERIES).alias("blocks")))
    sized = table.join(sizes, "label")
    members = sized.select("label", "vec_id", "v", "blocks", vectors.piece_of(F.col("parts")).alias("part"))
    anchors = sized.where(is_anchor).select("label", "vec_id", "v", "parts", "anchor_key", vectors.piece_of(F.col("blocks")).alias("block"))
    best = None
    for first, last in vectors.rounds(sizes.agg(F.max("parts")).first()[0] or 0):
        found = vectors.meet(with_least(anchors, best, k), members, ["label"], first, last, compare, POSITIVES)
        best = best_of(found, best, ["anchor_id", "anchor_key"], "positive_score", "positive_id", k)
    drop_stored(sizes)
    return best if best is not None else table.sparkSession.createDataFrame([], f"{POSITIVES}, rank int")


def with_least(anchors: DataFrame, best: DataFrame | None, k: int) -> DataFrame:
    """Anchors with the score that their k-th best row has reached so far; null before that."""
    if best is None:
        return anchors.withColumn("least", F.lit(None).cast("long"))
    reached = best.where(f"rank = {k}").select(F.col("anchor_id").alias("vec_id"), "anchor_key", F.col("positive_score").alias("least"))
    return anchors.join(reached, ["vec_id", "anchor_key"], "left")


def hard_negatives(
    rows: DataFrame, every: int, positives: int, negatives: int, low: int, high: int, scale: int, vector: str = "embedding", part_rows: int = vectors.PART_ROWS
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose vec_id ``every`` divides. A negative's score, times 100, lies between
    ``low`` and ``high`` times the positive's.
    """
    ids = rows.where("vec_id is not null and label is not null").withColumns({c: F.col(c).cast("long") for c in ("vec_id", "label")})
    table = vectors.whole_vectors(ids, vector, scale, ["vec_id", "label"])
    table = stored(table.withColumn("anchor_key", F.xxhash64("vec_id", "label", "v")))
    is_anchor = F.col("vec_id") % every == 0
    pairs = stored(nearest_of_label(table, is_anchor, positives, part_rows))

    # The window of each positive, at its place; scores are whole numbers, so bounds are rounded inwards.
    score = F.col("positive_score")
    whole = lambda x: F.expr(f"({x} - pmod({x}, 100)) div 100")  # noqa: E731  rounds down
    lowest = -whole(f"(-{low} * positive_score)")
    windows = pairs.select("anchor_id", "anchor_key", F.col("rank").alias("place"), score, lowest.alias("low"), whole(f"({high} * positive_score)").alias("high"))
    windows = stored(windows.where("low <= high"))
    count, asked = table.agg(F.count(F.lit(1)), F.count_if(is_anchor)).first()
    parts, blocks = -(-count // part_rows), -(-asked // vectors.BLOCK_QUERIES)
    members = table.select("vec_id", "v", "label", vectors.piece_of(max(parts, 1)).alias("part"), F.lit(blocks).alias("blocks"))
    anchors = table.where(is_anchor).select("vec_id", "v", "label", "anchor_key", vectors.piece_of(max(blocks, 1)).alias("block"), F.lit(parts).alias("parts"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, labels = (vectors.column(right, c) for c in ("vec_id", "label"))
        own, keys, label, asked_for = (left.column(c).to_pylist() for c in ("vec_id", "anchor_key", "label", "windows"))
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        for i, scores in score_slices(left, right):
            lowest, highest = min(w["low"] for w in asked_for[i]), max(w["high"] for w in asked_for[i])
            at = np.flatnonzero((labels != label[i]) & (ids != own[i]) & (scores >= lowest) & (scores <= highest))
            at = at[np.lexsort((ids[at], -scores[at]))]
            falling = -scores[at]
            for w in asked_for[i]:
                first, last = np.searchsorted(falling, -w["high"], "left"), np.searchsorted(falling, -w["low"], "right")
                taken = at[first : min(last, first + negatives)]
                n = len(taken)
                for part, values in zip(out, (np.full(n, own[i]), np.full(n, keys[i]), np.full(n, w["place"]), ids[taken], scores[taken]), strict=True):
                    part.append(values)
        return vectors.result(NEGATIVES, out)

    best = None
    by = ["anchor_id", "anchor_key", "place"]
    for first, last in vectors.rounds(parts):
        now = windows
        if best is not None:  # a window that is full takes no score below its last one
            full = best.where(f"rank = {negatives}").select(*by, F.col("negative_score").alias("reached"))
            now = windows.join(full, by, "left").withColumn("low", F.greatest("low", "reached"))
        lists = now.groupBy(F.col("anchor_id").alias("vec_id"), "anchor_key").agg(F.collect_list(F.struct("place", "low", "high")).alias("windows"))
        found = vectors.meet(anchors.join(lists, ["vec_id", "anchor_key"]), members, [], first, last, compare, NEGATIVES)
        best = best_of(found, best, by, "negative_score", "negative_id", negatives)
    if best is None:
        best = rows.sparkSession.createDataFrame([], f"{NEGATIVES}, rank int")
    chosen = pairs.withColumnRenamed("rank", "place").join(best, by)
    return chosen.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negative_digest(rows: DataFrame) -> DataFrame:
    """Anchors every 100th vec_id, 5 positives, 10 negatives at 30 to 90 percent; labels of every 7th vec_id moved on by one."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(rows.withColumn("label", moved), 100, 5, 10, 30, 90, 256)
