"""Registered queries of the training-data operators and the SQL statements that check them."""

from __future__ import annotations

from millwatch.llm import jaccard_join, knn_join, lexical, licenses, line_dedup, mixing, pieces, quality, sharding, suffix_dedup, toxicity, warc, whitening

QUERIES = {
    "op8_licenses": licenses.op8_licenses,
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_jaccard": jaccard_join.op2_jaccard,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op4_pieces": pieces.op4_pieces,
    "op10_warc": warc.op10_warc,
    "op3_topk": knn_join.op3_topk,
    "op5_quality": quality.op5_quality,
    "op7_mixing": mixing.op7_mixing,
    "op9_sharding": sharding.op9_sharding,
    "op12_suffix_dedup": suffix_dedup.op12_suffix_dedup,
    "op11_lexical": lexical.op11_lexical,
    "op13_whitening": whitening.op13_whitening,
}

ORACLES = {
    "op2_jaccard": jaccard_join.OP2_SQL,
    "op10_warc": warc.OP10_SQL,
    "op3_topk": knn_join.OP3_SQL,
    "op5_quality": quality.OP5_SQL,
    "op7_mixing": mixing.OP7_SQL,
    "op9_sharding": sharding.OP9_SQL,
    "op12_suffix_dedup": suffix_dedup.OP12_SQL,
    "op11_lexical": lexical.OP11_SQL,
}
