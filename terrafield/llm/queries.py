"""The queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import alignment, decontamination, html_text, licenses, lm_score, packing, periodic_runs, sentencepiece_nbest, simhash, simple8b, token_counts, topk, toxicity

QUERIES = {
    "op1_token_ids": simple8b.op1_token_ids,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_lm_score": lm_score.op3_lm_score,
    "op4_simhash": simhash.op4_simhash,
    "op5_sentencepiece": sentencepiece_nbest.op5_sentencepiece,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_html_text": html_text.op9_html_text,
    "op10_top_k": topk.op10_top_k,
    "op11_alignment": alignment.op11_alignment,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_packing": packing.op13_packing,
}

ORACLE_SQL = {"op6_decontamination": decontamination.OP6_SQL, "op10_top_k": topk.OP10_SQL}
