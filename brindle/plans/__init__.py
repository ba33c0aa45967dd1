"""Registered queries. The tables at hand aren't capture ledgers, so each query runs its operator over a table of the same shape: parts of two return flags stand for strategies, events for ledger entries, the first components of embeddings for points."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL that it must agree with."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def load() -> None:
    from . import contracts, experiments, files, ledgers, ranks, schedules, searches, space  # noqa: F401
