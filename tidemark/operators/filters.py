"""Filters (P-05, P-06, T-04).

Stacked filters stay separate ``filter`` calls; Catalyst merges them into one
predicate and pushes it into the Parquet scan.  A parameter that arrives as
text (a widget value, a job argument) is bound as a named SQL parameter and
cast to the column's type explicitly, instead of leaving Spark to cast the
text to ``BIGINT`` implicitly (which fails on non-numeric text under ANSI).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPS = {"=", "==", "!=", "<>", ">", ">=", "<", "<="}


def stacked_filters(df: DataFrame, predicates: Sequence[str | Column]) -> DataFrame:
    for p in predicates:
        df = df.filter(F.expr(p) if isinstance(p, str) else p)
    return df


def param_filter(df: DataFrame, column: str, op: str, value: str) -> DataFrame:
    """``column <op> value`` with ``value`` given as text."""
    if op not in _OPS:
        raise ValueError(f"unsupported comparison {op!r}")
    if column not in df.columns:
        raise ValueError(f"unknown column {column!r}")
    dtype = dict(df.dtypes)[column]
    return df.sparkSession.sql(
        f"SELECT * FROM {{src}} WHERE `{column}` {op} CAST(:value AS {dtype})",
        args={"value": value},
        src=df,
    )
