"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from brightsieve.llm import align, bpe, codebooks, decontaminate, line_runs, passages, pii, quality, records, sharding, simhash, topk, url_rules

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_url_filters": url_rules.op2_url_filters,
    "op3_sharding": sharding.op3_sharding,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op5_bpe": bpe.op5_bpe,
    "op6_topk": topk.op6_topk,
    "op7_pii": pii.op7_pii,
    "op8_records": records.op8_records,
    "op9_simhash": simhash.op9_simhash,
    "op10_passages": passages.op10_passages,
    "op11_line_dedup": line_runs.op11_line_dedup,
    "op12_alignment": align.op12_alignment,
    "op13_codes": codebooks.op13_codes,
}

SQL = {**codebooks.SQL, **decontaminate.SQL, **line_runs.SQL, **topk.SQL, **url_rules.SQL}
