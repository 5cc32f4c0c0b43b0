"""Registered queries of the package and the SQL of those that SQL can express."""

from kilnstream.llm import (
    byte_bpe,
    decontamination,
    fill_in_middle,
    hard_negatives,
    jaccard_join,
    language_id,
    line_dedup,
    near_duplicates,
    quality_rules,
    quotations,
    repeated_bytes,
    toxicity,
    url_filters,
)

QUERIES = {
    "op1_quotation_linking": quotations.op1_quotation_linking,
    "op2_decontamination": decontamination.op2_decontamination,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_byte_bpe": byte_bpe.op5_byte_bpe,
    "op6_language_id": language_id.op6_language_id,
    "op7_minhash": near_duplicates.op7_minhash,
    "op8_repeated_bytes": repeated_bytes.op8_repeated_bytes,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_url_filters": url_filters.op10_url_filters,
    "op11_fill_in_middle": fill_in_middle.op11_fill_in_middle,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_jaccard_join": jaccard_join.op13_jaccard_join,
}
ORACLES = {
    "op1_quotation_linking": quotations.ORACLE,
    "op2_decontamination": decontamination.ORACLE,
    "op4_quality_rules": quality_rules.ORACLE,
    "op7_minhash": "SELECT *, doc_id = component_id AS kept "
                   f"FROM ({jaccard_join.similar_sql(3, 85)})",
    "op10_url_filters": url_filters.ORACLE,
    "op11_fill_in_middle": fill_in_middle.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_jaccard_join": jaccard_join.ORACLE,
}
