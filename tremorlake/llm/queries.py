"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from tremorlake.llm import bag_minhash, bpe, divergence, line_dedup, merkle, mixing, passages, pieces, pii, quality, token_files, topk, warc

QUERIES = {
    q.__name__: q
    for q in (
        mixing.op1_mixing,
        line_dedup.op2_line_dedup,
        pii.op3_pii,
        bag_minhash.op4_near_dedup,
        warc.op5_warc,
        passages.op6_passages,
        topk.op7_topk,
        quality.op8_quality_rules,
        token_files.op9_token_files,
        bpe.op10_bpe,
        divergence.op11_divergence,
        pieces.op12_pieces,
        merkle.op13_merkle,
    )
}

ORACLES = {
    "op1_mixing": mixing.OP1_SQL,
    "op7_topk": topk.OP7_SQL,
    "op8_quality_rules": quality.OP8_SQL,
    "op11_divergence": divergence.OP11_SQL,
    "op13_merkle": merkle.OP13_SQL,
}
