"""Queries of the text operators and their DuckDB SQL, by name."""

from __future__ import annotations

from . import (
    collocations,
    decontaminate,
    fingerprints,
    hard_negatives,
    html_text,
    language_id,
    licenses,
    line_dedup,
    minhash,
    ngram_join,
    quality,
    sentencepiece_codec,
    token_planes,
)

QUERIES = {
    "op1_license_scan": licenses.query,
    "op2_line_dedup": line_dedup.query,
    "op3_fingerprints": fingerprints.query,
    "op4_decontaminate": decontaminate.query,
    "op5_ngram_join": ngram_join.query,
    "op6_quality": quality.query,
    "op7_html_text": html_text.query,
    "op8_language_id": language_id.query,
    "op9_token_planes": token_planes.query,
    "op10_sentencepiece": sentencepiece_codec.query,
    "op11_minhash": minhash.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_collocations": collocations.query,
}

SQL = {
    "op1_license_scan": licenses.SQL,
    "op2_line_dedup": line_dedup.SQL,
    "op4_decontaminate": decontaminate.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_collocations": collocations.SQL,
}
