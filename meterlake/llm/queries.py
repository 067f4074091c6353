"""The operators on documents as queries, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterlake.llm import (
    byte_bpe, exact_dedup, hard_negatives, lexical, licenses, line_dedup, neighbours, packing, pii, quality, repeats,
    sentence_pieces, simhash,
)
from meterlake.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def over_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_repeat_removal": over_documents(repeats.digest),
    "op2_best_fit_packing": over_documents(packing.pack),
    "op3_exact_dedup": over_documents(exact_dedup.exact_dedup),
    "op4_license_scan": over_documents(licenses.license_scan),
    "op5_line_dedup": over_documents(line_dedup.digest),
    "op6_simhash_near_dedup": over_documents(simhash.near_dedup),
    "op7_nearest_neighbours": neighbours.query,
    "op8_sentence_pieces": over_documents(sentence_pieces.digest),
    "op9_pii_surrogates": over_documents(pii.digest),
    "op10_quality_classifier": quality.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_lexical_search": lexical.query,
    "op13_byte_bpe": byte_bpe.query,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": exact_dedup.ORACLE_SQL,
    "op4_license_scan": licenses.oracle_sql(),
    "op5_line_dedup": line_dedup.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
    "op12_lexical_search": lexical.ORACLE_SQL,
}
