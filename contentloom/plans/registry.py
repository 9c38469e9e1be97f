"""Registration of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Family:
    """Queries of one area, by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            self.queries[name] = fn
            if sql:
                self.oracles[name] = sql
            return fn

        return register
