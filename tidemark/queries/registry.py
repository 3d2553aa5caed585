"""Query registry: a Spark query and, where SQL can say it, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import configure
from tidemark.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(configure(spark), folder.rstrip("/")))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build

    return add


def load_all() -> dict[str, Query]:
    from tidemark.queries import (  # noqa: F401
        aggregates,
        changes,
        columns,
        enrich,
        filters,
        incremental,
        joins,
        nested,
        ordering,
        quality,
        scalars,
        sinks,
        sources,
        streams,
        windows,
    )

    return REGISTRY
