"""The registered queries of this subpackage and their SQL."""

from stockwave.llm import (
    contamination, hard_negatives, mixing, ngram_join, packing, pii, quality_model, quality_rules, repeats, topk, url_filter, warc, whitening,
)

QUERIES = {
    "op1_dual_tree": topk.op1_dual_tree,
    "op2_warc": warc.op2_warc,
    "op3_mixing": mixing.op3_mixing,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_unit_hashing": repeats.op5_unit_hashing,
    "op6_divergence": quality_rules.op6_divergence,
    "op7_contexts": pii.op7_contexts,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_best_two_fit": packing.op9_best_two_fit,
    "op10_factorisation_machine": quality_model.op10_factorisation_machine,
    "op11_fm_index": contamination.op11_fm_index,
    "op12_kronecker": hard_negatives.op12_kronecker,
    "op13_block_matrix": whitening.op13_block_matrix,
}
ORACLES = {
    "op1_dual_tree": topk.OP1_SQL,
    "op2_warc": warc.OP2_SQL,
    "op3_mixing": mixing.OP3_SQL,
    "op11_fm_index": contamination.OP11_SQL,
    "op12_kronecker": hard_negatives.OP12_SQL,
}
