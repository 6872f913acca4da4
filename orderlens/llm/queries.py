"""The operators over their whole tables, by query name."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlens.llm.decontamination import contaminated
from orderlens.llm.edit_fingerprints import fingerprint_digest
from orderlens.llm.hard_negatives import hard_negative_digest
from orderlens.llm.impact_index import exact_top_k
from orderlens.llm.jaccard import document_components
from orderlens.llm.language import language_digest
from orderlens.llm.oracle import statements
from orderlens.llm.packing import packing_digest
from orderlens.llm.pii import pii_digest
from orderlens.llm.prefix_trie import prefix_trie
from orderlens.llm.secrets import secret_digest
from orderlens.llm.suffix_dedup import suffix_digest
from orderlens.llm.tables import table
from orderlens.llm.token_files import token_file_digest
from orderlens.llm.urls import judge


def over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": over("documents", lambda docs: packing_digest(docs, special_ids=True)),
        "op2_secrets": over("documents", secret_digest),
        "op3_token_files": over("documents", lambda docs: token_file_digest(docs, special_ids=True)),
        "op4_language": over("documents", language_digest),
        "op5_decontamination": decontamination,
        "op6_pii": over("documents", pii_digest),
        "op7_edit_fingerprints": over("documents", fingerprint_digest),
        "op8_suffix_dedup": over("documents", suffix_digest),
        "op9_urls": over("pages", judge),
        "op10_jaccard": over("documents", lambda docs: document_components(docs, 3, 90)),
        "op11_hard_negatives": over("embeddings", hard_negative_digest),
        "op12_prefix_trie": over("conversations", prefix_trie),
        "op13_top_k": over("embeddings", lambda rows: exact_top_k(rows, every=20, k=20, scale=64)),
    }


def oracle_sql() -> dict[str, str]:
    return statements()
