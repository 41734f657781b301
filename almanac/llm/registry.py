"""Registered corpus queries and their oracle SQL."""

from __future__ import annotations

import corpus_pipeline
from almanac.llm import (
    best_fit_packing,
    crf_language,
    divergence,
    license_join,
    manifest,
    merkle,
    mixing,
    secret_scan,
    spelling,
    superminhash,
    toxicity,
    url_filter,
    warc,
)

_PARTS = [
    warc, toxicity, superminhash, crf_language, mixing, divergence, license_join, best_fit_packing, secret_scan, merkle,
    spelling, manifest, url_filter,
]


def queries() -> dict:
    return {name: fn for part in _PARTS for name, fn in part.QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    own = {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}
    return own | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
