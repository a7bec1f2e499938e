"""Operators of a training-data pipeline, and the queries that apply them to whole tables."""

from __future__ import annotations

from jobmarket.llm import bsi_topk, bwt_dedup, cdc_dedup, cgk_decontam, merkle, mixing, ngram_join, pii, pseudo_likelihood, toxicity, url_templates, warc, whitening

QUERIES = {
    "op1_warc_derivatives": warc.op1,
    "op2_candidate_boosting_pii": pii.op2,
    "op3_bwt_merge_dedup": bwt_dedup.op3,
    "op4_weak_supervision_toxicity": toxicity.op4,
    "op5_bit_sliced_topk": bsi_topk.op5,
    "op6_grouped_prefix_join": ngram_join.op6,
    "op7_chunk_dedup": cdc_dedup.op7,
    "op8_cgk_decontamination": cgk_decontam.op8,
    "op9_entropy_balancing": mixing.op9,
    "op10_pseudo_likelihood": pseudo_likelihood.op10,
    "op11_butterfly_merkle": merkle.op11,
    "op12_exact_whitening": whitening.op12,
    "op13_path_templates": url_templates.op13,
}

ORACLES = {
    "op1_warc_derivatives": warc.OP1_SQL,
    "op5_bit_sliced_topk": bsi_topk.OP5_SQL,
    "op6_grouped_prefix_join": ngram_join.OP6_SQL,
    "op11_butterfly_merkle": merkle.OP11_SQL,
}
