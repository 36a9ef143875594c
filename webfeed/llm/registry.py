"""Queries of this subpackage for the driver contract, and their oracle SQL."""

from webfeed.llm import (alignment, bpe, decontaminate, divergence, jaccard_join, langid, licenses, line_dedup, quality,
                         suffix_dedup, topk, toxicity, warc)

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_quality": quality.op4_quality,
    "op5_language_id": langid.op5_language_id,
    "op6_byte_bpe": bpe.op6_byte_bpe,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_voronoi_top_k": topk.op10_voronoi_top_k,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_warc": warc.op13_warc,
}

ORACLES = {
    "op2_suffix_dedup": suffix_dedup.ORACLE_SQL,
    "op3_line_dedup": line_dedup.ORACLE_SQL,
    "op7_license_scan": licenses.ORACLE_SQL,
    "op8_jaccard_join": jaccard_join.ORACLE_SQL,
    "op10_voronoi_top_k": topk.ORACLE_SQL,
    "op11_source_divergence": divergence.ORACLE_SQL,
    "op13_warc": warc.ORACLE_SQL,
}
