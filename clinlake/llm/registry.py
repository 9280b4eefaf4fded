"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

import corpus_pipeline
from clinlake.llm import fingerprint, html_extract, jaccard_join, language_id, merkle, mixing, packing, sentencepiece_viterbi, suffix_dedup, token_store, url_filter, voronoi_topk, whitening

LLM_QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_voronoi_topk": voronoi_topk.op2_voronoi_topk,
    "op3_syncmer_fingerprints": fingerprint.op3_syncmer_fingerprints,
    "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
    "op5_sentencepiece_round_trip": sentencepiece_viterbi.op5_sentencepiece_round_trip,
    "op6_language_id": language_id.op6_language_id,
    "op7_ngram_jaccard_join": jaccard_join.op7_ngram_jaccard_join,
    "op8_html_extraction": html_extract.op8_html_extraction,
    "op9_url_filters": url_filter.op9_url_filters,
    "op10_token_store": token_store.op10_token_store,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_best_fit_packing": packing.op13_best_fit_packing,
}

LLM_ORACLE_SQL = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op2_voronoi_topk": voronoi_topk.OP2_SQL,
    "op7_ngram_jaccard_join": jaccard_join.OP7_SQL,
    "op9_url_filters": url_filter.OP9_SQL,
    "op12_merkle_manifest": merkle.OP12_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
