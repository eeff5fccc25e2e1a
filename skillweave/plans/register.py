"""Collects queries with the tables they read and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from skillweave.sources.fixtures import oracle_with, table


class Plans:
    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, name: str, *tables: str, sql: str | None = None) -> Callable:
        """Registers fn(*tables) -> DataFrame under name."""

        def register(fn: Callable[..., DataFrame]) -> Callable:
            assert name not in self.queries, name
            self.queries[name] = lambda spark, sf_dir: fn(*[table(spark, sf_dir, t) for t in tables])
            if sql is not None:
                self.oracles[name] = oracle_with(tables, sql)
            return fn

        return register
