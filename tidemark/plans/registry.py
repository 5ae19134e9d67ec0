"""Registry of named queries: one Spark plan and (when SQL can say it) one oracle text.

Modules under ``tidemark.plans`` register with :func:`register`; importing
:mod:`tidemark.plans.all` loads every module, and ``__spark_entry__`` reads
:data:`QUERIES` / :data:`ORACLES`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco
