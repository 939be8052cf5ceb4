"""Queries of the operators, and SQL with the same rows where SQL can say them."""

from __future__ import annotations

from tallyrock.llm import alignment, bpe, chat, decontaminate, divergence, extract, line_dedup, ngram_join, packing, quality, toxicity, warc, whitening

LLM_QUERIES = {
    "op1_bradley_terry": quality.op1_bradley_terry,
    "op2_warc_zstd": warc.op2_warc_zstd,
    "op3_bm25_packing": packing.op3_bm25_packing,
    "op4_segment_edit_join": line_dedup.op4_segment_edit_join,
    "op5_crf_toxicity": toxicity.op5_crf_toxicity,
    "op6_nearest_url": extract.op6_nearest_url,
    "op7_distribution_divergence": divergence.op7_distribution_divergence,
    "op8_block_max_wand": decontaminate.op8_block_max_wand,
    "op9_grammar_round_trip": chat.op9_grammar_round_trip,
    "op10_count_vector_rtree": ngram_join.op10_count_vector_rtree,
    "op11_pair_index_bpe": bpe.op11_pair_index_bpe,
    "op12_lockstep_alignment": alignment.op12_lockstep_alignment,
    "op13_jacobi_davidson": whitening.op13_jacobi_davidson,
}

LLM_ORACLES = {
    "op2_warc_zstd": warc.OP2_SQL,
    "op4_segment_edit_join": line_dedup.OP4_SQL,
    "op9_grammar_round_trip": chat.OP9_SQL,
    "op10_count_vector_rtree": ngram_join.OP10_SQL,
}
