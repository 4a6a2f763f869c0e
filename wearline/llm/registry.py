"""Queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

import functools

from wearline.llm import (
    cover_anchors,
    decontaminate,
    divergence,
    language_id,
    licenses,
    lm_score,
    mtree,
    near_duplicates,
    packing,
    prefix_trie,
    repeats,
    toxicity,
    warc,
)
from wearline.llm.common import ship

_MODULES = [
    cover_anchors,
    decontaminate,
    divergence,
    language_id,
    licenses,
    lm_score,
    mtree,
    near_duplicates,
    packing,
    prefix_trie,
    repeats,
    toxicity,
    warc,
]


def _shipped(query):
    @functools.wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: _shipped(query) for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in _MODULES for name, sql in module.ORACLE_SQL.items()}
