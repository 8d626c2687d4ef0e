"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from parcelcast.llm import (
    decontaminate, dualtree, filteraudit, hamming, htmltext, jaccard, linededup, mixing, nbsvm, secrets, substrings, tokenids, toxicity,
)


def queries() -> dict:
    return {
        "op1_top_k": hamming.op1_top_k,
        "op2_html_text": htmltext.op2_html_text,
        "op3_line_dedup": linededup.op3_line_dedup,
        "op4_ngram_jaccard": jaccard.op4_ngram_jaccard,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_decontamination": decontaminate.op6_decontamination,
        "op7_mixing": mixing.op7_mixing,
        "op8_substring_dedup": substrings.op8_substring_dedup,
        "op9_token_ids": tokenids.op9_token_ids,
        "op10_quality": nbsvm.op10_quality,
        "op11_secrets": secrets.op11_secrets,
        "op12_lexical_search": dualtree.op12_lexical_search,
        "op13_filter_audit": filteraudit.op13_filter_audit,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_top_k": hamming.ORACLE,
        "op3_line_dedup": linededup.ORACLE,
        "op7_mixing": mixing.ORACLE,
        "op12_lexical_search": dualtree.ORACLE,
        "op13_filter_audit": filteraudit.ORACLE,
    }
