"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import byte_bpe, embedding_dedup, exact_dedup, fm_dedup, licences, line_dedup, packing, quality, simhash, suffix_dedup

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_quality": quality.op3_quality,
    "op4_fm_dedup": fm_dedup.op4_fm_dedup,
    "op5_simhash": simhash.op5_simhash,
    "op6_embedding_dedup": embedding_dedup.op6_embedding_dedup,
    "op7_packing": packing.op7_packing,
    "op8_licences": licences.op8_licences,
    "op9_byte_bpe": byte_bpe.op9_byte_bpe,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
}

ORACLES = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op2_suffix_dedup": suffix_dedup.ORACLE,
    "op4_fm_dedup": fm_dedup.ORACLE,
    "op6_embedding_dedup": embedding_dedup.ORACLE,
    "op8_licences": licences.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
}
