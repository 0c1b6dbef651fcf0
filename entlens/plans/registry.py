"""Registered queries and the SQL that states what each must return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Builder], Builder]:
    def register(builder: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = builder
        if oracle is not None:
            ORACLES[name] = oracle
        return builder

    return register
