"""Null-safe row comparison (P-12).

``xxhash64`` skips nulls, so ``(a, null)`` and ``(null, a)`` hash alike, and
hashes depend on the column type.  Change detection therefore compares
null-safely column by column; the hash is only offered as an optional
pre-filter that carries one null flag per column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = 32


def _col(c: str | Column, prefix: str = "") -> Column:
    return F.col(f"{prefix}{c}") if isinstance(c, str) else c


def differs(left: Sequence[str | Column], right: Sequence[str | Column]) -> Column:
    """True when any pair differs; nulls compare equal to nulls (``NOT a <=> b``)."""
    if len(left) != len(right):
        raise ValueError("differs() needs the same number of columns on each side")
    if not left:
        return F.lit(False)
    if len(left) > WIDE:
        # one comparison of two structs (null fields compare equal) instead of
        # a deep OR chain that would outgrow generated-code limits
        names = [f"c{i}" for i in range(len(left))]
        ls = F.struct(*[_col(a).alias(n) for a, n in zip(left, names)])
        rs = F.struct(*[_col(b).alias(n) for b, n in zip(right, names)])
        return ~ls.eqNullSafe(rs)
    terms = [~_col(a).eqNullSafe(_col(b)) for a, b in zip(left, right)]
    return reduce(lambda x, y: x | y, terms)


def differs_prefixed(columns: Sequence[str], left_prefix: str, right_prefix: str) -> Column:
    return differs([f"{left_prefix}{c}" for c in columns], [f"{right_prefix}{c}" for c in columns])


def changed_columns(columns: Sequence[str], left_prefix: str, right_prefix: str) -> Column:
    """Array with the names of the columns whose values differ (null-safe)."""
    flags = [
        F.when(~F.col(f"{left_prefix}{c}").eqNullSafe(F.col(f"{right_prefix}{c}")), F.lit(c))
        for c in columns
    ]
    return F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")


def fingerprint(columns: Sequence[str | Column]) -> Column:
    """Row hash that distinguishes null positions.

    The values are hashed together with a bit mask of the null columns, so
    swapped nulls no longer collide.  Equal fingerprints still need a null-safe
    comparison to be sure; use it only to skip obviously changed rows early.
    """
    cols = [_col(c) for c in columns]
    mask = F.concat_ws("", *[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return F.xxhash64(mask, *cols)
