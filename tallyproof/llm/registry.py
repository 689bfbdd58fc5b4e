"""Queries of the numbered operators, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyproof.llm import merkle, mixing, ngram_join, quality_rules, url_filter, vector_codes
from tallyproof.llm.bpe import op9_bpe
from tallyproof.llm.merkle import op11_merkle_manifest
from tallyproof.llm.mixing import op1_poisson_mix
from tallyproof.llm.ngram_join import op3_ngram_join
from tallyproof.llm.passages import op6_passage_dedup
from tallyproof.llm.pii import op10_lstm_pii
from tallyproof.llm.quality_model import op5_subword_quality
from tallyproof.llm.quality_rules import op4_quality_rules
from tallyproof.llm.sharding import op8_vector_packing
from tallyproof.llm.token_counts import op12_token_counts
from tallyproof.llm.url_filter import op7_url_filter
from tallyproof.llm.vector_codes import op13_vector_codes
from tallyproof.llm.vptree import op2_vptree

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_poisson_mix": op1_poisson_mix,
    "op2_vptree": op2_vptree,
    "op3_ngram_join": op3_ngram_join,
    "op4_quality_rules": op4_quality_rules,
    "op5_subword_quality": op5_subword_quality,
    "op6_passage_dedup": op6_passage_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_vector_packing": op8_vector_packing,
    "op9_bpe": op9_bpe,
    "op10_lstm_pii": op10_lstm_pii,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_token_counts": op12_token_counts,
    "op13_vector_codes": op13_vector_codes,
}
ORACLES: dict[str, str] = {
    "op1_poisson_mix": mixing.ORACLE,
    "op3_ngram_join": ngram_join.ORACLE,
    "op4_quality_rules": quality_rules.oracle(),
    "op7_url_filter": url_filter.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op13_vector_codes": vector_codes.ORACLE,
}
