"""Registry of named queries: each is a Spark builder plus (when SQL can say
the same thing) the DuckDB oracle text used by the correctness check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    doc: str


_REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def wrap(fn: Builder) -> Builder:
        old = _REGISTRY.get(name)
        # The same function registering again (its module imported twice) is fine;
        # two different functions claiming one key is a mistake.
        if old is not None and old.build.__qualname__ != fn.__qualname__:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return wrap


def _load() -> None:
    # Importing the family modules fills the registry.
    from vendorscope.plans import (  # noqa: F401
        q_pages, q_vendors, q_answers, q_tables, q_enrich, q_facts, q_tokens, q_io, q_flow,
    )


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_REGISTRY)
