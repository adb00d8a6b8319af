"""Registered queries on text corpora, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyroll.llm.decontaminate import op1_benchmark_decontamination
from tallyroll.llm.licenses import op4_license_scan
from tallyroll.llm.near_dups import op9_near_duplicates
from tallyroll.llm.negatives import op11_hard_negatives
from tallyroll.llm.packing import op10_pack_sequences
from tallyroll.llm.quality_model import op2_quality_classifier
from tallyroll.llm.quality_rules import op8_quality_rules
from tallyroll.llm.repeats import op6_suffix_array_dedup
from tallyroll.llm.secrets import op5_secret_scan
from tallyroll.llm.sharding import op12_shards
from tallyroll.llm.token_counts import op3_token_counts
from tallyroll.llm.token_files import op7_token_files
from tallyroll.llm.whitening import op13_embedding_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_benchmark_decontamination,
        op2_quality_classifier,
        op3_token_counts,
        op4_license_scan,
        op5_secret_scan,
        op6_suffix_array_dedup,
        op7_token_files,
        op8_quality_rules,
        op9_near_duplicates,
        op10_pack_sequences,
        op11_hard_negatives,
        op12_shards,
        op13_embedding_whitening,
    )
}

ORACLE_SQL: dict[str, str] = {}
