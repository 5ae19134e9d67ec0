"""Change classification (C-01, C-02) and key checks (M-04).

Plan shape: the distinct batch keys (partially aggregated, so a hot key
collapses to one row per map task) split the target by ``LEFT SEMI`` /
``LEFT ANTI``.  The key set is the build side: with a small batch it is
broadcast and the large target is only scanned.  ``missing`` is the anti
side; the batch is left-joined to the semi side (small against small, and the
batch is the streamed side, so AQE may split a skewed batch key) for ``new``
/ ``update`` / ``unchanged``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.compare import changed_columns, differs_prefixed
from tidemark.operators.merge import split_by_keys
from tidemark.session import stage

# Fixed labels: ours, and the reference's (which folds unchanged and missing).
LABELS = {"new": "new", "update": "update", "unchanged": "unchanged", "missing": "missing", "null_key": "null_key"}
COMPAT_LABELS = {"new": "New", "update": "Update", "unchanged": "Exist", "missing": "Exist", "null_key": "Exist"}
PRESENCE_COMPAT_LABELS = {"new": "New", "update": "Update", "unchanged": "Update", "missing": "NA", "null_key": "New"}


def _any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def classify_changes(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    *,
    labels: dict[str, str] | None = None,
    with_changed_columns: bool = False,
    stage_keys: bool = False,
) -> DataFrame:
    """Classify every key of ``batch`` and ``target``.

    ``change`` is ``new`` (only in the batch), ``update`` (in both, some
    ``compare`` column differs null-safely), ``unchanged`` (in both, equal),
    ``missing`` (only in the target) or ``null_key`` (batch row with a null key:
    it can match nothing and should be quarantined).  With ``compare=None``
    every matched key is an ``update`` (presence-only classification, C-02).
    ``target`` must hold one row per key (e.g. its active slice).
    """
    keys = list(keys)
    labels = labels or LABELS
    cmp = list(compare or [])
    t = target.select(*keys, *[F.col(c).alias(f"t__{c}") for c in cmp], F.lit(True).alias("t__present"))
    b = batch.select(*keys, *[F.col(c).alias(f"b__{c}") for c in cmp])

    batch_keys = batch.select(*keys).filter(~_any_null(keys)).distinct()
    if stage_keys:
        batch_keys = stage(batch_keys, "classify-keys")
    # the missing side reads the target's keys only
    t_touched, t_rest = split_by_keys(t, batch_keys, keys)[0], split_by_keys(target.select(*keys), batch_keys, keys)[1]
    joined = b.join(t_touched, keys, "left")
    if cmp:
        is_update = differs_prefixed(cmp, "t__", "b__")
    else:
        is_update = F.lit(True)
    change = (
        F.when(_any_null(keys), labels["null_key"])
        .when(F.col("t__present").isNull(), labels["new"])
        .when(is_update, labels["update"])
        .otherwise(labels["unchanged"])
    )
    out_cols = [*keys, change.alias("change")]
    if with_changed_columns:
        out_cols.append(
            F.when(F.col("t__present").isNotNull(), changed_columns(cmp, "t__", "b__")).alias("changed_columns")
        )
    from_batch = joined.select(*out_cols)

    missing = t_rest.select(*keys, F.lit(labels["missing"]).alias("change"))
    if with_changed_columns:
        missing = missing.withColumn("changed_columns", F.lit(None).cast("array<string>"))
    return from_batch.unionByName(missing)


def classify_by_presence(target: DataFrame, batch: DataFrame, keys: Sequence[str], *, compat: bool = False) -> DataFrame:
    """C-02: presence only; target keys are de-duplicated first."""
    target_keys = target.select(*keys).distinct()
    return classify_changes(target_keys, batch, keys, None, labels=PRESENCE_COMPAT_LABELS if compat else None)


def key_conflicts(df: DataFrame, keys: Sequence[str], min_count: int = 2) -> DataFrame:
    """M-04 / A-02: keys that occur at least ``min_count`` times, with their count.

    ``count`` is partially aggregated before the shuffle, so a key holding a
    third of the rows costs one row per map task on the wire.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_count)
    )

