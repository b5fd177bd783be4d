"""Queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from riftspan.llm import attribution, chat, collocations, cosine, exact, language, merkle, mixing, pieces, simhash, spelling, toxicity, urls

QUERIES = {
    "op1_url_templates": urls.op1_url_templates,
    "op2_fixity_audit": merkle.op2_fixity_audit,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_language_id": language.op4_language_id,
    "op5_token_attribution": attribution.op5_token_attribution,
    "op6_simhash": simhash.op6_simhash,
    "op7_embedding_links": cosine.op7_embedding_links,
    "op8_exact_dedup": exact.op8_exact_dedup,
    "op9_sentencepiece": pieces.op9_sentencepiece,
    "op10_mixing": mixing.op10_mixing,
    "op11_chat": chat.op11_chat,
    "op12_collocations": collocations.op12_collocations,
    "op13_spelling": spelling.op13_spelling,
}

ORACLES = {"op2_fixity_audit": merkle.ORACLE, "op8_exact_dedup": exact.ORACLE, "op11_chat": chat.ORACLE, "op12_collocations": collocations.ORACLE}
