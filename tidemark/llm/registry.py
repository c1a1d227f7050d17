"""The queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm import byte_repeats, decontam, exact_dedup, infill, langid, mixing, quality
from tidemark.llm import sharding, simhash, token_counts, token_store, whitening, word_repeats

QUERIES = {
    "op1_language_id": langid.op1_language_id,
    "language_id_pages": langid.language_id_pages,
    "op2_simhash_near_dedup": simhash.op2_simhash_near_dedup,
    "op3_mixing": mixing.op3_mixing,
    "op4_suffix_array_dedup": byte_repeats.op4_suffix_array_dedup,
    "op5_token_id_output": token_store.op5_token_id_output,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_benchmark_decontamination": decontam.op7_benchmark_decontamination,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_substring_dedup": word_repeats.op9_substring_dedup,
    "op10_sharding": sharding.op10_sharding,
    "sharding_fine": sharding.sharding_fine,
    "op11_exact_dedup": exact_dedup.op11_exact_dedup,
    "op12_embedding_whitening": whitening.op12_embedding_whitening,
    "op13_fill_in_middle": infill.op13_fill_in_middle,
    "pipeline": corpus_pipeline.run,
}
SQL = {
    "op3_mixing": mixing.MIXING_SQL,
    "op10_sharding": sharding.sql(sharding.SHARD_BYTES),
    "sharding_fine": sharding.sql(64 << 10),
    "op11_exact_dedup": exact_dedup.EXACT_DEDUP_SQL,
    "op13_fill_in_middle": infill.FILL_IN_MIDDLE_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
