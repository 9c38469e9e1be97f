"""Spark-native content enrichment: typed extraction, quality gates, near-duplicate
removal, enrichment tables and the wide metadata view, as DataFrame functions."""

from contentloom.session import get_session

__all__ = ["get_session"]
