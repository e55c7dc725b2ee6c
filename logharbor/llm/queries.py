"""The registered queries of this subpackage and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logharbor.llm import bpe, chat, contamination, exact_dedup, lexical, lines, merkle, minhash, nearest, pages, quality, repeats, toxicity
from logharbor.llm.common import read_table, session

Build = Callable[[SparkSession, str], DataFrame]


def over(table: str, operator: Callable[[DataFrame], DataFrame]) -> Build:
    """A query that applies an operator to one whole table."""
    return lambda spark, sf_dir: operator(read_table(session(spark), sf_dir, table))


QUERIES: dict[str, Build] = {
    "op1_bpe": over("documents", bpe.digest_rows),
    "op2_chat_format": chat.op2_chat_format,
    "op3_suffix_dedup": over("documents", repeats.digest_rows),
    "op4_line_dedup": lines.op4_line_dedup,
    "op5_quality": quality.op5_quality,
    "op6_exact_dedup": over("documents", exact_dedup.digest_rows),
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_decontaminate": contamination.op8_decontaminate,
    "op9_main_text": pages.op9_main_text,
    "op10_minhash_dedup": over("documents", minhash.component_rows),
    "op11_ranked_search": lexical.op11_ranked_search,
    "op12_merkle_manifest": over("documents", merkle.manifest_rows),
    "op13_top_k_search": over("embeddings", nearest.search_rows),
}

ORACLE_SQL: dict[str, str] = {
    "op3_suffix_dedup": repeats.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op8_decontaminate": contamination.ORACLE,
    "op10_minhash_dedup": minhash.ORACLE,
    "op11_ranked_search": lexical.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_top_k_search": nearest.ORACLE,
}
