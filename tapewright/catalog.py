"""All registered queries of the core package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import queries as plain
from .plans import log_queries, replay_queries, stream_queries, verify_queries, wire_queries  # noqa: F401  register their queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(plain.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(plain.SQL)
