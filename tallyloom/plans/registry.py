"""Registered queries: a Spark builder, the ids it covers and, where SQL can say it, the SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    covers: tuple[str, ...]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def register(build: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, build, tuple(covers.split()), sql)
        return build

    return register
