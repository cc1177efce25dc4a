"""The registered queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from mercata.llm import (
    bpe,
    kneser_ney,
    language_id,
    mixing,
    neighbours,
    packing,
    quality_rules,
    simhash,
    spelling,
    suffix_dedup,
    token_files,
    vector_codes,
    warc,
)

QUERIES = {
    "op1_bpe": bpe.query,
    "op2_simhash": simhash.query,
    "op3_quality_rules": quality_rules.query,
    "op4_token_files": token_files.query,
    "op5_neighbours": neighbours.query,
    "op6_warc": warc.query,
    "op7_suffix_dedup": suffix_dedup.query,
    "op8_language_id": language_id.query,
    "op9_kneser_ney": kneser_ney.query,
    "op10_packing": packing.query,
    "op11_vector_codes": vector_codes.query,
    "op12_spelling": spelling.query,
    "op13_mixing": mixing.query,
}

ORACLE_SQL = {
    "op3_quality_rules": quality_rules.ORACLE,
    "op6_warc": warc.ORACLE,
    "op11_vector_codes": vector_codes.ORACLE,
}
