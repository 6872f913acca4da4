"""Whole-number vectors, and a query set against all of them in blocks.

A block of queries meets a part of the rows in one task, so no task grows with the table. Parts are met
in rounds of growing size (part 0, then up to 8 parts, 64, ...): what a query has found so far bounds
what a later part may return, so the rows returned grow with the logarithm of the number of parts.
"""

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a part and queries of a block, about; a hash deals them.
PART_ROWS, BLOCK_QUERIES = 16384, 1024
#: The parts of a round end at this multiple of where those of the round before it ended.
GROWTH = 8
#: Sums of products must stay below this; larger components end the job instead of wrapping around.
LARGEST = 1 << 62

KINDS = {"long": pa.int64(), "int": pa.int32()}


def whole_vectors(rows: DataFrame, vector: str, scale: int, keep: Sequence[str | Column]) -> DataFrame:
    """``keep`` and v, the components as floor(scale * x); exact copies of a row count once.

    Rows with a null vector or any null or non-finite component are left out.
    """
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    v = F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v")
    return rows.where(x.isNotNull() & finite).select(*keep, v).distinct()


def matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    """Vectors as rows of ``dims`` whole numbers; missing components count as 0."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), dims), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def matrices(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of both sides, filled up to the length of the longest one."""
    sides = [pa.concat_arrays(t.column("v").chunks) for t in (left, right)]
    dims = max(pc.max(pc.list_value_length(side)).as_py() for side in sides)
    return matrix(sides[0], dims), matrix(sides[1], dims)


def column(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy()


def result(schema: str, columns: Sequence[list[np.ndarray]]) -> pa.Table:
    """A table of ``schema`` from the pieces of each column."""
    fields = [field.split() for field in schema.split(", ")]
    arrays = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), KINDS[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.Table.from_arrays(arrays, [name for name, _ in fields])


def piece_of(pieces: Column | int) -> Column:
    """Which of so many pieces a row belongs to."""
    return F.pmod(F.xxhash64("vec_id", "v"), F.lit(pieces) if isinstance(pieces, int) else pieces).cast("int")


def rounds(parts: int) -> Iterator[tuple[int, int]]:
    """First and last part of each round."""
    first, end = 0, 1
    while first < parts:
        yield first, min(end, parts) - 1
        first, end = end, end * GROWTH


def meet(queries: DataFrame, members: DataFrame, by: Sequence[str], first: int, last: int, compare: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``compare`` of every block of queries with each part from ``first`` to ``last`` under the same ``by``.

    queries: by, block, parts (of the members), vec_id, v, ...; members: by, part, blocks (of the
    queries), vec_id, v, ...
    """
    asked = queries.where(F.col("parts") > first).withColumn("part", F.explode(F.sequence(F.lit(first), F.least(F.lit(last), F.col("parts") - 1))))
    held = members.where(F.col("part").between(first, last)).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return result(schema, [[] for _ in schema.split(", ")])
        return compare(left, right)

    keys = [*by, "block", "part"]
    # Both sides may come from one table: new names keep their columns apart.
    held = held.select(*[F.col(c).alias(c) for c in held.columns])
    return asked.drop("parts").groupBy(*keys).cogroup(held.drop("blocks").groupBy(*keys)).applyInArrow(both, schema)
