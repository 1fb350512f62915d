"""The queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from corpusloom.llm import backoff, covertree, htmltext, language, merkle, mixing, packing, secrets, simhash, toxicity


def queries() -> dict:
    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_embeddings": covertree.op2_embeddings,
        "op3_fingerprints": merkle.op3_fingerprints,
        "op4_secrets": secrets.op4_secrets,
        "op5_mixing": mixing.op5_mixing,
        "op6_backoff": backoff.op6_backoff,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_packing": packing.op8_packing,
        "op9_html": htmltext.op9_html,
        "op10_language": language.op10_language,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_embeddings": covertree.ORACLE, "op5_mixing": mixing.ORACLE, "op6_backoff": backoff.ORACLE}
