"""The queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from wattspan.llm import (
    bpe, codes, decontaminate, importance, lines, packing, quality, sharding, simhash, surrogates, tokens,
    topk, toxicity,
)

QUERIES = {
    "op1_line_dedup": lines.op1_line_dedup,
    "op2_simhash": simhash.op2_simhash,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_surrogates": surrogates.op4_surrogates,
    "op5_topk": topk.op5_topk,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_shards": sharding.op7_shards,
    "op8_packing": packing.op8_packing,
    "op9_tokens": tokens.op9_tokens,
    "op10_quality": quality.op10_quality,
    "op11_importance": importance.op11_importance,
    "op12_vector_codes": codes.op12_vector_codes,
    "op13_bpe": bpe.op13_bpe,
}

SQL = {
    "op1_line_dedup": lines.OP1_SQL,
    "op5_topk": topk.OP5_SQL,
    "op11_importance": importance.OP11_SQL,
    "op12_vector_codes": codes.OP12_SQL,
}
