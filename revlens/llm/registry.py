"""The queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from revlens.llm import op01_license, op02_packing, op03_quality, op04_neighbours, op05_pii, op06_mixing, op07_language, op08_jaccard, op09_toxicity, op10_passages, op11_balltree, op12_simhash, op13_alignment

QUERIES = {
    "op1_license_scan": op01_license.op1_license_scan,
    "op2_best_fit_packing": op02_packing.op2_best_fit_packing,
    "op3_suffix_repetition": op03_quality.op3_suffix_repetition,
    "op4_kmeans_tree_neighbours": op04_neighbours.op4_kmeans_tree_neighbours,
    "op5_skip_chain_pii": op05_pii.op5_skip_chain_pii,
    "op6_temperature_mixing": op06_mixing.op6_temperature_mixing,
    "op7_hierarchical_language": op07_language.op7_hierarchical_language,
    "op8_ngram_jaccard": op08_jaccard.op8_ngram_jaccard,
    "op9_counterfactual_toxicity": op09_toxicity.op9_counterfactual_toxicity,
    "op10_compact_windows": op10_passages.op10_compact_windows,
    "op11_ball_tree_search": op11_balltree.op11_ball_tree_search,
    "op12_multi_index_simhash": op12_simhash.op12_multi_index_simhash,
    "op13_tokenizer_alignment": op13_alignment.op13_tokenizer_alignment,
}

ORACLES = {
    "op3_suffix_repetition": op03_quality.ORACLE,
    "op6_temperature_mixing": op06_mixing.ORACLE,
    "op11_ball_tree_search": op11_balltree.ORACLE,
}
