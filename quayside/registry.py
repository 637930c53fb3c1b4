"""Registry of named queries: key -> (spark builder, oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the driver tables (or data Spark derives from them).  The oracle SQL is
DuckDB SQL over the same parquet tables, used only for verification.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        _QUERIES[key] = fn
        if oracle is not None:
            _ORACLE[key] = oracle
        return fn
    return deco


def _load():
    # importing the catalog modules fills the registry
    from quayside.catalog import models, semantic_queries, quality_queries, analytics_queries  # noqa: F401
    from quayside.catalog import stateful_queries, source_queries, cdc_queries  # noqa: F401


def queries() -> dict[str, Builder]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
