"""The queries of this package, and their SQL for DuckDB where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from presswork.llm import (
    decontaminate,
    html_text,
    jaccard,
    language,
    mixing,
    near_vectors,
    prefix_trie,
    runs,
    secrets,
    sharding,
    suffixes,
    token_files,
    topk,
)

QUERIES = {
    "op1_top_k": topk.op1_top_k,
    "op2_remove_repeats": suffixes.op2_remove_repeats,
    "op3_main_text": html_text.op3_main_text,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_scan_secrets": secrets.op6_scan_secrets,
    "op7_shard_documents": sharding.op7_shard_documents,
    "op8_identify_language": language.op8_identify_language,
    "op9_token_files": token_files.op9_token_files,
    "op10_jaccard_join": jaccard.op10_jaccard_join,
    "op11_periodic_runs": runs.op11_periodic_runs,
    "op12_near_vectors": near_vectors.op12_near_vectors,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op1_top_k": topk.SQL,
    "op2_remove_repeats": suffixes.SQL,
    "op4_decontaminate": decontaminate.SQL,
    "op5_mix_sources": mixing.SQL,
    "op6_scan_secrets": secrets.SQL,
    "op7_shard_documents": sharding.SQL,
    "op10_jaccard_join": jaccard.SQL,
    "op12_near_vectors": near_vectors.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
