"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tiffin.llm import (
    chat,
    codes,
    exact_dedup,
    language,
    lm_score,
    mixing,
    packing,
    periodic,
    personal,
    quality,
    secrets,
    simhash,
    warc,
)

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_chat_format": chat.op2_chat_format,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_mixing": mixing.op4_mixing,
    "op5_language_id": language.op5_language_id,
    "op6_warc": warc.op6_warc,
    "op7_lm_score": lm_score.op7_lm_score,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_simhash": simhash.op9_simhash,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_vector_codes": codes.op11_vector_codes,
    "op12_personal_data": personal.op12_personal_data,
    "op13_periodic_runs": periodic.op13_periodic_runs,
}

ORACLE_SQL = {
    "op2_chat_format": chat.OP2_SQL,
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op6_warc": warc.OP6_SQL,
    "op11_vector_codes": codes.OP11_SQL,
}
