"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricemill.llm import (
    bpe, context_tree, conversations, fingerprints, html_text, language, mixing, near_duplicates, personal_data, search, sharding, warc,
    whitening,
)
from pricemill.llm.common import table
from pricemill.llm.sql import PERSONAL_DATA_SQL, WARC_SQL

Query = Callable[[SparkSession, str], DataFrame]


def over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


QUERIES: dict[str, Query] = {
    "op1_document_fingerprints": over("documents", fingerprints.fingerprint_documents),
    "op2_language_id": over("documents", language.identify_languages),
    "op3_source_mixing": over("documents", mixing.mix),
    "op4_sentencepiece": over("documents", bpe.encode_documents),
    "op5_near_duplicates": over("documents", near_duplicates.near_duplicate_classes),
    "op6_lm_scoring": over("documents", context_tree.score_documents),
    "op7_topk_search": over("documents", search.search_every_20th),
    "op8_html_extraction": over("pages", html_text.extract_pages),
    "op9_warc": over("pages", warc.archive_pages),
    "op10_sharding": over("documents", sharding.shard_documents),
    "op11_conversation_repair": over("conversations", conversations.repair_damaged),
    "op12_personal_data": over("documents", personal_data.digest_personal_data),
    "op13_embedding_whitening": over("embeddings", whitening.whiten),
}

ORACLE_SQL: dict[str, str] = {"op9_warc": WARC_SQL, "op12_personal_data": PERSONAL_DATA_SQL}
