"""All registered queries (name -> callable(spark, sf_dir)) and oracle SQL."""

from __future__ import annotations

from mediasift.plans import corpus_queries, dedup_queries, media_queries, record_queries, stream_queries

QUERIES = {}
ORACLE = {}
for _mod in (dedup_queries, corpus_queries, media_queries, record_queries, stream_queries):
    QUERIES.update(_mod.QUERIES)
    ORACLE.update(_mod.ORACLE)
