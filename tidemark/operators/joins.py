"""Join building blocks of the history flow (J-02, J-03).

Both join the (possibly huge) target against a *distinct*, staged key set:
the distinct is partially aggregated before the shuffle (a hot key costs one
row per map task) and staging gives the planner its real size, so a small key
set is broadcast and the target is only scanned.  ``attach_columns`` keeps the
caller's rows on the streamed side, where AQE may split a skewed key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.history import ACTIVE, INACTIVE
from tidemark.session import stage


def demote_matched(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    *,
    version_col: str = "eskey",
    status_col: str = "status",
    demoted_version: int = 1,
    stage_keys: bool = True,
) -> DataFrame:
    """J-02: rows of ``target`` whose key is in ``batch`` become the previous
    version (``version_col = 1``, ``status = InActive``); others keep theirs."""
    keys = list(keys)
    hit = batch.select(*keys).distinct().withColumn("__hit", F.lit(True))
    if stage_keys:
        hit = stage(hit, "demote-keys")
    j = target.join(hit, keys, "left")
    m = F.col("__hit").isNotNull()
    vtype = dict(target.dtypes)[version_col]
    return j.select(
        *[
            F.when(m, F.lit(demoted_version).cast(vtype)).otherwise(F.col(c)).alias(c) if c == version_col
            else F.when(m, F.lit(INACTIVE)).otherwise(F.col(c)).alias(c) if c == status_col
            else F.col(c)
            for c in target.columns
        ]
    )


def attach_columns(rows: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str],
                   *, stage_keys: bool = True) -> DataFrame:
    """J-03: fetch ``columns`` of the target row with the same ``keys`` (e.g.
    ``id`` + ``status``) onto each row; null when there is none.

    The target is first cut to the rows' keys by a ``LEFT SEMI`` join against
    the (staged, distinct) key set -- broadcast when small -- so only that
    slice is joined to the rows."""
    keys = list(keys)
    wanted = rows.select(*keys).distinct()
    if stage_keys:
        wanted = stage(wanted, "attach-keys")
    slice_ = target.select(*keys, *columns).join(wanted, keys, "left_semi")
    return rows.join(slice_, keys, "left")


__all__ = ["ACTIVE", "INACTIVE", "attach_columns", "demote_matched"]
