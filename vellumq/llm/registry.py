"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from vellumq.llm import chat, decontaminate, divergence, firstseen, jaccard, neighbours, packing, polytope, private, quality, repeats, secrets, toxicity

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_personal_data": private.op2_personal_data,
    "op3_repeated_passages": repeats.op3_repeated_passages,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_decontamination": decontaminate.op5_decontamination,
    "index_matches": decontaminate.index_matches,
    "op6_secret_scan": secrets.op6_secret_scan,
    "op7_chat_formatting": chat.op7_chat_formatting,
    "op8_ngram_jaccard_join": jaccard.op8_ngram_jaccard_join,
    "op9_nearest_neighbours": neighbours.op9_nearest_neighbours,
    "op10_quality": quality.op10_quality,
    "op11_near_vectors": polytope.op11_near_vectors,
    "op12_first_seen_lines": firstseen.op12_first_seen_lines,
    "op13_source_divergence": divergence.op13_source_divergence,
}

ORACLES = {
    "op3_repeated_passages": repeats.ORACLE_SQL,
    "op5_decontamination": decontaminate.ORACLE_SQL,
    "index_matches": decontaminate.MATCHES_SQL,
    "op6_secret_scan": secrets.ORACLE_SQL,
    "op7_chat_formatting": chat.ORACLE_SQL,
    "op8_ngram_jaccard_join": jaccard.ORACLE_SQL,
    "op12_first_seen_lines": firstseen.ORACLE_SQL,
    "op13_source_divergence": divergence.ORACLE_SQL,
}
