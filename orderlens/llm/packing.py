"""Packing token sequences into fixed windows by best-fit decreasing.

Overlong documents are cut into full windows first; the rest of each document is at most one
piece under the window length. Pieces are dealt into shards by a hash, and each shard packs its
pieces longest first, each into the tightest open window that still holds it. A segment tree over
the remaining capacity (1 to the window length) finds that window, so a shard of n pieces costs
n log(window) steps. A shard leaves a few windows with room, a vanishing share of its pieces.

Defined results: a null text is an empty one, which is the end id alone; ties go by document id
and start; repeated rows are packed as often as they occur; an empty table gives no rows; columns
besides doc_id and text are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.tables import in_slices
from orderlens.llm.tokens import VOCABULARY, WordTokenizer

WINDOW = 1024

#: Pieces that one shard packs. More make less padding, fewer make smaller tasks.
SHARD_PIECES = 20_000

PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, ids binary"


def token_pieces(docs: DataFrame, window: int = WINDOW, end_id: int = 0, vocabulary: str = VOCABULARY, special_ids: bool = False) -> DataFrame:
    """Each document's ids and the end id, cut into windows; ids are little-endian 32 bit."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(vocabulary, special_ids=special_ids)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for low, high in in_slices(texts):
                flat, count = tokenizer.encode(texts[low:high])
                ends = np.cumsum(count)
                flat = np.insert(flat, ends, end_id).astype("<u4")
                total = count + 1
                pieces = -(-total // window)
                row = np.repeat(np.arange(len(total)), pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
                length = np.minimum(window, total[row] - start)
                at = (np.cumsum(total) - total)[row] + start
                ids = [flat[a : a + n].tobytes() for a, n in zip(at, length, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low).take(pa.array(row)),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(total[row], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECE_SCHEMA)


class OpenWindows:
    """Open windows by remaining capacity, with a segment tree of the capacities in use."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = bytearray(2 * self.size)
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, number: int) -> None:
        if not self.stacks[capacity]:
            node = capacity + self.size
            while node and not self.tree[node]:
                self.tree[node] = 1
                node >>= 1
        self.stacks[capacity].append(number)

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least capacity of at least ``need``: (capacity, number)."""
        node, tree = need + self.size, self.tree
        if not tree[node]:
            while node and (node & 1 or not tree[node + 1]):
                node >>= 1
            if not node:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        capacity = node - self.size
        number = self.stacks[capacity].pop()
        if not self.stacks[capacity]:
            tree[node] = 0
            node >>= 1
            while node and not (tree[2 * node] or tree[2 * node + 1]):
                tree[node] = 0
                node >>= 1
        return capacity, number


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """(window number, offset) of each piece; ``lengths`` fall from first to last."""
    open_windows, numbers, offsets, made = OpenWindows(window), [], [], 0
    for length in lengths:
        if length == window or (found := open_windows.take(length)) is None:
            found, made = (window, made), made + 1
        capacity, number = found
        numbers.append(number)
        offsets.append(window - capacity)
        if capacity > length:
            open_windows.put(capacity - length, number)
    return numbers, offsets


def pack_pieces(pieces: DataFrame, shards: int, window: int = WINDOW) -> DataFrame:
    """Add sequence_id and offset to pieces of (doc_id, start, length, ...), none over ``window``.

    All other columns go along. ``sequence_id`` is the shard in the high and the window's number
    in the low 32 bits.
    """
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.drop(["shard"]).sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        numbers, offsets = best_fit(table.column("length").to_pylist(), window)
        ids = (key[0].as_py() << 32) + np.array(numbers, np.int64)
        return table.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets, pa.int64()))

    shard = F.pmod(F.xxhash64("doc_id", "start"), F.lit(shards)).cast("long")
    return pieces.withColumn("shard", shard).groupBy("shard").applyInArrow(pack, schema)


def shard_count(docs: DataFrame, window: int = WINDOW, shard_pieces: int = SHARD_PIECES) -> int:
    """Shards for all pieces. A full window has as many bytes as ids at least, which bounds the pieces."""
    sizes = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    return 1 + (sizes[0] + (sizes[1] or 0) // window) // shard_pieces


def pack_documents(docs: DataFrame, window: int = WINDOW, end_id: int = 0, special_ids: bool = False) -> DataFrame:
    """All pieces of all documents with their ids and places."""
    return pack_pieces(token_pieces(docs, window, end_id, special_ids=special_ids), shard_count(docs, window), window)


def packing_digest(docs: DataFrame, special_ids: bool = False) -> DataFrame:
    """Places of all pieces with a checksum of their ids instead of the ids."""
    pieces = token_pieces(docs, special_ids=special_ids).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack_pieces(pieces, shard_count(docs)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
