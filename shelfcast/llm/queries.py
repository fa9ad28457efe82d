"""The registered text queries and the SQL of those that SQL can express."""

from __future__ import annotations

from shelfcast.llm import (
    decontamination,
    divergence,
    language,
    licences,
    mixing,
    packing,
    pages,
    pii,
    quality,
    repeats,
    repetition,
    simhash,
    whitening,
)

QUERIES = {
    "op1_poisson_mixing": mixing.op1_mix,
    "op2_suffix_repetition": repetition.op2_repetition,
    "op3_bestfit_packing": packing.op3_packing,
    "op4_simhash_vptree": simhash.op4_simhash,
    "op5_html_density": pages.op5_html,
    "op6_lsa_decontamination": decontamination.op6_decontamination,
    "op7_pii_boosting": pii.op7_pii,
    "op8_licence_sentences": licences.op8_licences,
    "op9_subword_quality": quality.op9_quality,
    "op10_column_repeats": repeats.op10_repeats,
    "op11_divergence_audit": divergence.op11_divergence,
    "op12_ftrl_language": language.op12_language,
    "op13_lanczos_whitening": whitening.op13_whitening,
}

ORACLES = {
    "op1_poisson_mixing": mixing.OP1_SQL,
    "op2_suffix_repetition": repetition.OP2_SQL,
    "op8_licence_sentences": licences.OP8_SQL,
    "op11_divergence_audit": divergence.OP11_SQL,
}
