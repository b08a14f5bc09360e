"""Registry of named queries: a Spark builder and, where SQL can express
the operator, the equivalent DuckDB SQL over the same parquet tables.

Query modules register themselves with ``@query(name, sql)``; the driver
contract in ``__spark_entry__.py`` reads the registry.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, note: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, note)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # Importing the query modules fills the registry.
    from threadscope.plans import queries, queries_extract, queries_io, queries_ops  # noqa: F401
    return REGISTRY
