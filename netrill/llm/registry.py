"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

import corpus_pipeline
from netrill.llm import (
    collocations,
    decontamination,
    language_model,
    lexical_search,
    licenses,
    main_text,
    near_duplicates,
    pieces,
    privacy,
    quality,
    repeats,
    toxicity,
    warc,
)

QUERIES = {
    "op1_decontamination": decontamination.query,
    "op2_license_scan": licenses.query,
    "op3_repeats": repeats.query,
    "op4_warc_bundles": warc.query,
    "op5_near_duplicates": near_duplicates.query,
    "op6_privacy": privacy.query,
    "op7_toxicity": toxicity.query,
    "op8_language_model": language_model.query,
    "op9_quality_rules": quality.query,
    "op10_sentencepiece": pieces.query,
    "op11_main_text": main_text.query,
    "op12_lexical_search": lexical_search.query,
    "op13_collocations": collocations.query,
    "pipeline": corpus_pipeline.run,
}

STATEMENTS = {
    "op1_decontamination": decontamination.SQL,
    "op2_license_scan": licenses.SQL,
    "op4_warc_bundles": warc.SQL,
    "op5_near_duplicates": near_duplicates.SQL,
    "op9_quality_rules": quality.SQL,
    "op12_lexical_search": lexical_search.SQL,
    "op13_collocations": collocations.SQL,
}
if corpus_pipeline.ORACLE_SQL is not None:
    STATEMENTS["pipeline"] = corpus_pipeline.ORACLE_SQL
