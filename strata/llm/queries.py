"""All queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from strata.llm import (
    q_decontaminate,
    q_html,
    q_language,
    q_linededup,
    q_neardup,
    q_phrases,
    q_pii,
    q_quality,
    q_resample,
    q_sentencepieces,
    q_substrings,
    q_suffixes,
    q_tokens,
)

_MODULES = (q_quality, q_linededup, q_tokens, q_substrings, q_neardup, q_sentencepieces, q_decontaminate, q_html, q_language, q_pii,
            q_resample, q_phrases, q_suffixes)
QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
