"""The queries of this package and the SQL that states them."""

from __future__ import annotations

from raretide.llm import (decontaminate, filter_audit, langid, licenses, maxscore, mixing, multiset_hash, quality, secrets, simhash, suffixes, warc,
                          whitening)

QUERIES = {
    "op1_warc_normaliser": warc.op1_warc_normaliser,
    "op2_suffix_repeats": suffixes.op2_suffix_repeats,
    "op3_maxscore_top5": maxscore.op3_maxscore_top5,
    "op5_language_codes": langid.op5_language_codes,
    "op8_secret_findings": secrets.op8_secret_findings,
    "op9_license_sentences": licenses.op9_license_sentences,
    "op6_benchmark_leaks": decontaminate.op6_benchmark_leaks,
    "op10_quality_ranking": quality.op10_quality_ranking,
    "op4_source_mix": mixing.op4_source_mix,
    "op7_simhash_components": simhash.op7_simhash_components,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_embedding_whitening": whitening.op12_embedding_whitening,
    "op13_document_fingerprints": multiset_hash.op13_document_fingerprints,
}

ORACLE: dict[str, str] = {
    "op1_warc_normaliser": warc.SQL,
    "op3_maxscore_top5": maxscore.SQL,
    "op4_source_mix": mixing.SQL,
    "op9_license_sentences": licenses.SQL,
    "op11_filter_audit": filter_audit.SQL,
}
