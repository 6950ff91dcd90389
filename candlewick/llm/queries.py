"""The operators' queries and SQL by name."""

from __future__ import annotations

from candlewick.llm import (
    decontaminate, extract, language, linededup, neardup, phrases, pieces, quality, shards, suffixtree, toxicity, urls, vectorcodes,
)

QUERIES = {
    "op1_language_id": language.op1_language_id,
    "op2_sentencepiece": pieces.op2_sentencepiece,
    "op3_url_filters": urls.op3_url_filters,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_lm_scoring": suffixtree.op7_lm_scoring,
    "op8_html_extraction": extract.op8_html_extraction,
    "op9_hilbert_shards": shards.op9_hilbert_shards,
    "op10_simhash_neardup": neardup.op10_simhash_neardup,
    "op11_line_dedup": linededup.op11_line_dedup,
    "op12_phrase_collocations": phrases.op12_phrase_collocations,
    "op13_vector_codes": vectorcodes.op13_vector_codes,
}
ORACLES = {
    "op3_url_filters": urls.ORACLE,
    "op6_quality_rules": quality.ORACLE,
    "op11_line_dedup": linededup.ORACLE,
    "op12_phrase_collocations": phrases.ORACLE,
    "op13_vector_codes": vectorcodes.ORACLE,
}
