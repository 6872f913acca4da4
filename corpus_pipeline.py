"""A training corpus from ``documents``: five stages, each written before the next one reads it.

Language ID drops documents without a letter, the n-gram join keeps one document of each group of
near copies, decontamination drops documents that contain benchmark items, personal data is masked
in the text, and what is left is packed into windows of token ids.

Each stage decides row by row: rows without doc_id and rows that share one are told apart by a row
number (``keyed``), so a rejected row takes no other with it. Of a group of near copies the row with
the smallest doc_id stays, one without doc_id only if no other has one.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.decontamination import contaminated
from orderlens.llm.jaccard import document_components
from orderlens.llm.language import UNKNOWN, predict
from orderlens.llm.packing import packing_digest
from orderlens.llm.pii import redact
from orderlens.llm.tables import stored, table

#: What tells the rows of a stage apart.
KEY = "row_key"

#: Near copies: sets of five words, at least this percent alike.
WORDS, PERCENT = 5, 80


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of its own for each row, in the order of doc_id.

    That is doc_id, unless rows lack it or share it: then all are stored with a row number.
    """
    ids = docs.groupBy(F.col("doc_id").cast("long").alias(KEY)).agg(F.count(F.lit(1)).alias("n"))
    if not ids.where(f"{KEY} is null or n > 1").limit(1).count():
        return docs.withColumn(KEY, F.col("doc_id").cast("long"))
    # Hashes only spread rows without doc_id, or of one doc_id, over the ranges of the sort.
    ordered = docs.orderBy(F.asc_nulls_last(F.col("doc_id").cast("long")), F.xxhash64("text"))
    return stored(ordered.withColumn(KEY, F.monotonically_increasing_id()))


def by_key(docs: DataFrame) -> DataFrame:
    """Keyed rows as the operators take them."""
    return docs.withColumn("doc_id", F.col(KEY)).drop(KEY)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; only null texts and texts without a letter go, the model rejects none."""
    rows = keyed(docs)
    rejected = stored(predict(by_key(rows)).where(F.col("lang_pred") == UNKNOWN).select(F.col("doc_id").alias(KEY)))
    return rows.join(rejected, KEY, "left_anti").select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies, and all single ones."""
    rows = keyed(docs)
    found = document_components(by_key(rows), WORDS, PERCENT)
    copies = stored(found.where("doc_id <> component_id").select(F.col("doc_id").alias(KEY)))
    return rows.join(copies, KEY, "left_anti").select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    rows = keyed(docs)
    leaks = stored(contaminated(by_key(rows), table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(KEY)).distinct())
    return rows.join(leaks, KEY, "left_anti").select(docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in ``text`` masked and ``n_chars`` counted anew."""
    return redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their windows, as ``packing_digest`` gives them."""
    return packing_digest(docs, special_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_copies", one_of_each),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: The stages are statistical models, set joins and a tokenizer: tests/llm checks them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
