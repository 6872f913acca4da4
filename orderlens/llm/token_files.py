"""Token ids in binary shards: frequency-ranked ids, one to four bytes each, control bytes apart.

An id is replaced by its rank among all ids of the corpus, so common ids are small numbers. A rank
takes one to four bytes; two bits per rank tell how many, four to a control byte. Control bytes
and data bytes are separate columns of a Parquet shard, a row per block of documents. A reader
gets byte counts of a whole control byte from a 256-row table and gathers all ranks of a block
at once. The rank table (an entry per vocabulary id) is stored beside the shards.

Shards are in ascending document order: documents are dealt to ranges of doc_id, sorted there, and
each block knows its range and its place in it.

Defined results: a null text is empty and has the end id alone; a null doc_id sorts first; rows
with equal doc_id keep an order by text; an empty table gives empty shards.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.tables import drop_stored, in_slices, shared_folder, stored
from orderlens.llm.tokens import VOCABULARY, word_tokenizer

END_ID = 2

#: Characters of text in a block, one document at least: bounds the memory of writer and reader.
BLOCK_CHARS = 1 << 20

RAW_SCHEMA = "part int, block int, before long, doc_ids array<long>, counts array<long>, ids binary"
SHARD_SCHEMA = RAW_SCHEMA.replace("ids binary", "control binary, data binary")

SHIFTS = np.array([0, 2, 4, 6], np.uint8)
#: Byte lengths of the four ranks that a control byte describes.
CONTROL_LENGTHS = (((np.arange(256)[:, None] >> SHIFTS) & 3) + 1).astype(np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    control = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    control[: len(ranks)] = extra
    control = control.reshape(-1, 4) << SHIFTS
    control = control[:, 0] | control[:, 1] | control[:, 2] | control[:, 3]
    ends = np.cumsum(extra, dtype=np.int64) + np.arange(1, len(ranks) + 1)
    starts = ends - extra - 1
    data = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    data[starts] = ranks & 0xFF
    for byte in range(1, int(extra.max(initial=0)) + 1):
        longer = np.flatnonzero(extra >= byte)
        data[starts[longer] + byte] = (ranks[longer] >> (8 * byte)) & 0xFF
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The inverse of ``encode_ranks``."""
    lengths = CONTROL_LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    raw = np.frombuffer(data, np.uint8)
    ranks = raw[starts].astype("<u4")
    for byte in range(1, int(lengths.max(initial=1))):
        longer = np.flatnonzero(lengths > byte)
        ranks[longer] |= raw[starts[longer] + byte].astype("<u4") << (8 * byte)
    return ranks


def id_type(vocabulary_size: int) -> str:
    """The bytes of an id in work tables."""
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


def token_blocks(docs: DataFrame, end_id: int = END_ID, vocabulary: str = VOCABULARY, special_ids: bool = False) -> DataFrame:
    """Blocks of documents in ascending order with their raw ids, still to be ranked."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, block, before = word_tokenizer(vocabulary, special_ids), 0, 0
        kind = id_type(tokenizer.tokenizer.get_vocab_size())
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            part = batch.column("part")[0].as_py() if batch.num_rows else 0
            # Words are looked up for several blocks at once.
            for first, last in in_slices(texts):
                flat, count = tokenizer.encode(texts[first:last])
                flat = np.insert(flat.astype(kind), np.cumsum(count), end_id)
                ends = np.concatenate([[0], np.cumsum(count + 1)])
                for low, high in in_slices(texts[first:last], BLOCK_CHARS):
                    ids = flat[ends[low] : ends[high]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part], pa.int32()),
                            pa.array([block], pa.int32()),
                            pa.array([before], pa.int64()),
                            pa.array([batch.column("doc_id").slice(first + low, high - low).to_pylist()], pa.list_(pa.int64())),
                            pa.array([count[low:high] + 1], pa.list_(pa.int64())),
                            pa.array([ids.tobytes()], pa.binary()),
                        ],
                        ["part", "block", "before", "doc_ids", "counts", "ids"],
                    )
                    block, before = block + 1, before + len(ids)

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.withColumn("part", F.spark_partition_id()).mapInArrow(blocks, RAW_SCHEMA)


def id_ranks(blocks: DataFrame, vocabulary_size: int) -> np.ndarray:
    """Rank of every id by its count over all blocks; at most one row per vocabulary id is gathered."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kind = np.zeros(vocabulary_size, np.int64), id_type(vocabulary_size)
        for batch in batches:
            for ids in batch.column("ids"):
                total += np.bincount(np.frombuffer(ids.as_buffer(), kind), minlength=vocabulary_size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counts = blocks.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(vocabulary_size, np.int64)
    frequency[counts["id"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    ranks = np.empty(vocabulary_size, np.uint32)
    ranks[np.lexsort((np.arange(vocabulary_size), -frequency))] = np.arange(vocabulary_size, dtype=np.uint32)
    return ranks


def write_token_files(docs: DataFrame, folder: str, end_id: int = END_ID, vocabulary: str = VOCABULARY, special_ids: bool = False) -> None:
    """Write the shards of ``docs`` under ``folder``/shards and their rank table under ``folder``/ranks."""
    spark = docs.sparkSession
    size = word_tokenizer(vocabulary, special_ids).tokenizer.get_vocab_size()
    kind = id_type(size)
    blocks = stored(token_blocks(docs, end_id, vocabulary, special_ids))
    ranks = id_ranks(blocks, size)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                control, data = encode_ranks(ranks[np.frombuffer(row.column("ids")[0].as_buffer(), kind)])
                columns = [row.column(c) for c in ("part", "block", "before", "doc_ids", "counts")]
                columns += [pa.array([control], pa.binary()), pa.array([data], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "block", "before", "doc_ids", "counts", "control", "data"])

    table = [(int(i), int(r)) for i, r in enumerate(ranks)]
    spark.createDataFrame(table, "id int, rank int").coalesce(1).write.parquet(f"{folder}/ranks")
    # Spark reads stored files by falling size: blocks are put in order again before they are written.
    ordered = blocks.repartitionByRange("part", "block").sortWithinPartitions("part", "block")
    ordered.mapInArrow(encode, SHARD_SCHEMA).write.option("compression", "none").parquet(f"{folder}/shards")
    drop_stored(blocks)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; ids are little-endian 32 bit."""
    table = spark.read.parquet(f"{folder}/ranks").orderBy("rank").toPandas()
    id_of = table["id"].to_numpy(np.uint32)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                counts = np.array(row["counts"], np.int64)
                ids = id_of[decode_ranks(row["control"], row["data"], int(counts.sum()))].astype("<u4")
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["part_before"] + row["before"] + ends - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([ids[e - n : e].tobytes() for e, n in zip(ends, counts, strict=True)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{folder}/shards")
    tokens = F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)
    # A block knows the ids before it in its range; ranges are as few as shuffle partitions.
    parts = shards.groupBy("part").agg(F.sum(tokens).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_before"))
    shards = shards.join(F.broadcast(parts), "part")
    return shards.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def token_file_digest(docs: DataFrame, special_ids: bool = False) -> DataFrame:
    """Write the files of all documents, read them back and sum up each document's ids."""
    folder = shared_folder(docs.sparkSession)
    write_token_files(docs, folder, special_ids=special_ids)
    return read_token_files(docs.sparkSession, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
