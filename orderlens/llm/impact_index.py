"""Exact top-k inner products through an impact-ordered index, score at a time.

The rows are dealt to parts; each part is an index with two posting lists per dimension, one for either
sign of a query's component. The impact of a posting is how far its component lies above the least one
(below the greatest one, for the other sign), so every posting adds to a score and none takes away.
Impacts are quantised to ``LEVELS`` levels; the postings of one level form a segment.

A query takes the segments of all its lists by descending weighted impact and adds the quantised impact
to the accumulators of the segment's rows. What the segments ahead can still add to a row, and what
quantising left out, bound its score from above; the exact scores of the k leading rows and what the
query found in earlier parts bound the k-th score from below. Processing stops only when few enough rows
can still belong to the answer, all others being ruled out by the two bounds, or when no segment is left.
The rows that can still belong are scored exactly.

Defined results: null or non-finite components, null vectors and null vec_ids leave a row out; exact
copies of a row count once; rows that share vec_id but not the vector are rows of their own, and none
of them is a candidate of a query with that vec_id (such queries rank their answers each for itself);
missing components of a shorter vector count as 0; ties go to the smaller vec_id; an empty table gives
no rows; columns besides vec_id and the vector are ignored. Components must be small: their largest product with
a query's, times 8 and the squared length, must stay below 2**53.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm import vectors
from orderlens.llm.tables import drop_stored, stored

LEVELS = 255
#: Shares of a part's postings after which a query looks at the bounds.
LOOKS = (0.55, 0.65, 0.75, 1.0)
#: Open rows, as a share of the part, from which scoring them is cheaper than going on.
OPEN_SHARE = 1 / 8

#: Accumulators are float64, which holds whole numbers up to here.
EXACT = 1 << 53

FOUND = "query_id long, query_key long, vec_id long, score long"


class ImpactIndex:
    """The rows of one part: ids and whole-number vectors.

    The lists of dimension d are number d for positive components of a query and ``dims + d`` for
    negative ones; postings stand by falling level, and level l ends at ``upto[list, l]``.
    """

    def __init__(self, ids: np.ndarray, v: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, v = ids[order], v[order]
        self.exact = v.astype(np.float64)
        self.low, self.high = v.min(axis=0), v.max(axis=0)
        self.step = np.maximum(1, -(-(self.high - self.low) // LEVELS))
        levels = np.concatenate([(v - self.low) // self.step, (self.high - v) // self.step], axis=1).T.astype(np.uint8)
        self.rows = np.argsort(LEVELS - levels, axis=1, kind="stable")
        self.tops = levels.max(axis=1).astype(np.int64)
        counts = np.array([np.bincount(x, minlength=self.tops.max() + 2) for x in levels])
        self.upto = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact scores; float64 holds them and all their partial sums."""
        return (self.exact[rows] @ q.astype(np.float64)).astype(np.int64)

    def top(self, q: np.ndarray, k: int, own: int, least: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows, best first, without id ``own`` and scores below ``least``."""
        open_rows = np.flatnonzero(self.ids != own)
        few = max(k, int(len(self.ids) * OPEN_SHARE))
        if len(open_rows) > few:
            open_rows = self.undecided(q, k, open_rows, few, least)
        exact = self.scores(open_rows, q)
        keep = np.flatnonzero(exact >= least) if least is not None else np.arange(len(exact))
        best = keep[np.lexsort((self.ids[open_rows[keep]], -exact[keep]))[:k]]
        return self.ids[open_rows[best]], exact[best]

    def undecided(self, q: np.ndarray, k: int, others: np.ndarray, few: int, least: int | None) -> np.ndarray:
        """Those of the rows ``others`` that can still be among the k best, or reach ``least``."""
        used = np.flatnonzero(q)
        lists = used + len(q) * (q[used] < 0)
        weight = np.abs(q[used])
        unit, tops = weight * self.step[used], self.tops[lists]
        base = int((np.maximum(q, 0) * self.low + np.minimum(q, 0) * self.high).sum())
        slack = int((weight * (self.step[used] - 1)).sum())  # what quantising can have left out
        # An accumulator holds the rows' sum of impacts and, in units of ``one``, how many lists named it.
        one = 1 << int((unit * tops).sum()).bit_length()
        both = np.zeros(len(self.ids))
        # Segments by falling impact, and how many postings there are down to each.
        level = np.arange(self.upto.shape[1] - 2, 0, -1)
        size = self.upto[lists][:, level] - self.upto[lists][:, level + 1]
        impact = unit[:, None] * level
        order = np.argsort(-impact[size > 0], kind="stable")
        falling, postings = impact[size > 0][order], np.cumsum(size[size > 0][order])
        done, floor = tops + 1, least  # levels from ``done`` on up are processed
        for share in LOOKS:
            if not len(falling):
                break
            cut = int(falling[min(np.searchsorted(postings, share * postings[-1]), len(falling) - 1)])
            to = np.minimum(np.maximum(1, -(-cut // unit)), done)  # all segments with this impact or more
            first, end = self.upto[lists, done].tolist(), self.upto[lists, to].tolist()
            now = (level >= to[:, None]) & (level < done[:, None])
            rows = np.concatenate([self.rows[x, i:j] for x, i, j in zip(lists.tolist(), first, end, strict=True)])
            both += np.bincount(rows, np.repeat((impact[now] + one).astype(np.float64), size[now]), len(both))
            done = to
            seen, score = np.divmod(both[others].astype(np.int64), one)
            # A list that was begun adds at most ``ahead`` to a row it has not named yet, others their top.
            begun, bound = done <= tops, unit * (done - 1)
            ahead = int(bound[begun].max(initial=0))
            most = score + ahead * (int(begun.sum()) - seen) + int(bound[~begun].sum()) + base + slack
            # The exact scores of the leaders are a proof that the k-th best has no less than theirs.
            leaders = others[np.argpartition(-most, k - 1)[:k]]
            reached = int(self.scores(leaders, q).min())
            floor = reached if floor is None else max(floor, reached)
            others = others[most >= floor]
            if len(others) <= few:
                break
        return others


def exact_top_k(rows: DataFrame, every: int, k: int, scale: int, vector: str = "embedding", part_rows: int = vectors.PART_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query, a row whose vec_id ``every`` divides."""
    ids = rows.where("vec_id is not null").withColumn("vec_id", F.col("vec_id").cast("long"))
    table = stored(vectors.whole_vectors(ids, vector, scale, ["vec_id"]))
    is_query = F.col("vec_id") % every == 0
    count, asked = table.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    parts, blocks = -(-count // part_rows), -(-asked // vectors.BLOCK_QUERIES)
    members = table.withColumns({"part": vectors.piece_of(max(parts, 1)), "blocks": F.lit(blocks)})
    queries = table.where(is_query).withColumns({"query_key": F.xxhash64("vec_id", "v"), "block": vectors.piece_of(max(blocks, 1)), "parts": F.lit(parts)})

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        q, v = vectors.matrices(left, right)
        if float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * 8 * max(1, v.shape[1]) ** 2 >= EXACT:
            raise ValueError("scores do not fit: components are too large")
        index = ImpactIndex(vectors.column(right, "vec_id"), v) if v.shape[1] else None
        out: list[list[np.ndarray]] = [[], [], [], []]
        for i, (own, key, least) in enumerate(zip(*(left.column(c).to_pylist() for c in ("vec_id", "query_key", "least")), strict=True)):
            if index:
                found, score = index.top(q[i], k, own, least)
            else:  # vectors without components: every score is 0
                every_id = vectors.column(right, "vec_id")
                found = np.sort(every_id[every_id != own])[:k]
                score = np.zeros(len(found), np.int64)
            for part, values in zip(out, (np.full(len(found), own), np.full(len(found), key), found, score), strict=True):
                part.append(values)
        return vectors.result(FOUND, out)

    best_first = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id", "place")
    best = None
    for first, last in vectors.rounds(parts):
        if best is None:
            limited = queries.withColumn("least", F.lit(None).cast("long"))
        else:  # what k rows have reached already, a k-th one must reach
            floors = best.where(f"rank = {k}").select(F.col("query_id").alias("vec_id"), "query_key", F.col("score").alias("least"))
            limited = queries.join(floors, ["vec_id", "query_key"], "left")
        found = vectors.meet(limited, members, [], first, last, compare, FOUND)
        found = found if best is None else found.union(best.select(*[c.split()[0] for c in FOUND.split(", ")]))
        ranked = found.withColumn("place", F.monotonically_increasing_id()).withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
        before, best = best, stored(ranked.drop("place"))
        if before is not None:
            drop_stored(before)
    if best is None:
        best = rows.sparkSession.createDataFrame([], f"{FOUND}, rank int")
    drop_stored(table)
    return best.select("query_id", "rank", "vec_id", "score")
