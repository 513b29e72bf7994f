"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

from sheaf.llm import chat, decontaminate, exact_dedup, fingerprints, licenses, line_dedup, manifest, near_dedup, pieces, pii, quality, warc, whitening


def queries() -> dict:
    return {
        "op1_line_dedup": line_dedup.op1_line_dedup,
        "op2_quality_classifier": quality.op2_quality_classifier,
        "op3_sentencepiece": pieces.op3_sentencepiece,
        "op4_warc": warc.op4_warc,
        "op5_exact_dedup": exact_dedup.op5_exact_dedup,
        "op6_near_dedup": near_dedup.op6_near_dedup,
        "op7_license_scan": licenses.op7_license_scan,
        "op8_chat_formatting": chat.op8_chat_formatting,
        "op9_personal_data": pii.op9_personal_data,
        "op10_decontamination": decontaminate.op10_decontamination,
        "op11_fingerprints": fingerprints.op11_fingerprints,
        "op12_whitening": whitening.op12_whitening,
        "op13_manifest": manifest.op13_manifest,
    }


def oracles() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.ORACLE,
        "op4_warc": warc.ORACLE,
        "op5_exact_dedup": exact_dedup.ORACLE,
        "op6_near_dedup": near_dedup.ORACLE,
        "op8_chat_formatting": chat.ORACLE,
        "op11_fingerprints": fingerprints.ORACLE,
        "op13_manifest": manifest.ORACLE,
    }
