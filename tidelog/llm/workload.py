"""The registered queries of this package and the SQL they must agree with."""

from __future__ import annotations

from tidelog.llm import (
    bag_search,
    bpe,
    exact_index,
    importance,
    license_scan,
    line_join,
    packing,
    pfair,
    ppm,
    ring_simhash,
    spot_signatures,
    target_draw,
    toxicity,
)

CORPUS_QUERIES = {
    "op1_line_dedup": line_join.op1_line_dedup,
    "op2_importance_resampling": importance.op2_importance_resampling,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_spot_signatures": spot_signatures.op4_spot_signatures,
    "op5_pfair_mixing": pfair.op5_pfair_mixing,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_ppm_scores": ppm.op7_ppm_scores,
    "op8_bpe_round_trip": bpe.op8_bpe_round_trip,
    "op9_simhash_ring": ring_simhash.op9_simhash_ring,
    "op10_exact_dedup": exact_index.op10_exact_dedup,
    "op11_bag_search": bag_search.op11_bag_search,
    "op12_best_fit_packing": packing.op12_best_fit_packing,
    "op13_target_resampling": target_draw.op13_target_resampling,
}

CORPUS_EXPECTED = {
    "op1_line_dedup": line_join.EXPECTED,
    "op4_spot_signatures": spot_signatures.EXPECTED,
    "op10_exact_dedup": exact_index.EXPECTED,
    "op11_bag_search": bag_search.EXPECTED,
    "op13_target_resampling": target_draw.EXPECTED,
}
