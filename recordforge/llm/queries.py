"""The queries of the training-data operators and the SQL that some of them equal."""

from __future__ import annotations

from . import covertree, fingerprints, language, licenses, mixing, pii, sentencepieces, simhash, substrings, urls

QUERIES = {
    "op1_fingerprint": fingerprints.op1_fingerprint,
    "op2_substrings": substrings.op2_substrings,
    "op3_language": language.op3_language,
    "op4_licenses": licenses.op4_licenses,
    "op5_urls": urls.op5_urls,
    "op6_pii": pii.op6_pii,
    "op7_mix": mixing.op7_mix,
    "op8_embeddings": covertree.op8_embeddings,
    "op9_sentencepiece": sentencepieces.op9_sentencepiece,
    "op10_simhash": simhash.op10_simhash,
}

ORACLES = {
    "op2_substrings": substrings.ORACLE,
    "op5_urls": urls.ORACLE,
    "op7_mix": mixing.ORACLE,
    "op8_embeddings": covertree.ORACLE,
}
