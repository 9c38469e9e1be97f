"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from contentloom.plans import (
    analytics_queries,
    backlog_queries,
    content_queries,
    enrichment_queries,
    maintenance_queries,
    streaming_queries,
)

_MODULES = (
    content_queries,
    backlog_queries,
    analytics_queries,
    enrichment_queries,
    maintenance_queries,
    streaming_queries,
)


def all_queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.FAMILY.queries.items()}


def all_oracles() -> dict:
    return {k: v for m in _MODULES for k, v in m.FAMILY.oracles.items()}
