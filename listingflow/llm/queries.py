"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from . import brown, decontam, jaccard_join, lexical, packing, pii, quality, sharding, substring, token_counts, warc, wavelet, whitening

QUERIES = {
    "op1_warc_segments": warc.query,
    "op2_mixture_packing": packing.query,
    "op3_brown_classes": brown.query,
    "op4_token_counts": token_counts.query,
    "op5_benchmark_decontamination": decontam.query,
    "op6_parity_sketch_join": jaccard_join.query,
    "op7_quality_trees": quality.query,
    "op8_hash_tree_sharding": sharding.query,
    "op9_wavelet_ids": wavelet.query,
    "op10_repeated_substrings": substring.query,
    "op11_geometric_blocks": lexical.query,
    "op12_bilstm_crf_pii": pii.query,
    "op13_choleskyqr_whitening": whitening.query,
}

#: Tokenizers, trained models and file formats of our own have no SQL form: those are tested
#: against brute force, exact round trips and held-out data instead.
ORACLES = {
    "op1_warc_segments": warc.ORACLE,
    "op5_benchmark_decontamination": decontam.ORACLE,
    "op6_parity_sketch_join": jaccard_join.ORACLE,
    "op10_repeated_substrings": substring.ORACLE,
    "op11_geometric_blocks": lexical.ORACLE,
}
