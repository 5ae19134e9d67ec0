"""Functional merges (M-01 .. M-04).

Stock Parquet tables cannot ``MERGE``, so every merge here is a pure function
``(target, source) -> new target state``.  The shape is always:

1. the source is aggregated by key (partial aggregation first, so a hot key
   costs one row per map task) -- this enforces the M-04 rule (one source
   row per target key);
2. the target is left-joined to it: one projection picks, per column, the
   updated or the stored value.  The source is the build side, so a small batch
   is broadcast and the (large) target is scanned but not shuffled;
3. source rows whose key is not among the target's keys are inserted; for that
   the key columns of the target are read a second time.

Counts of inserted / updated / deleted / copied rows are collected with an
optional :class:`pyspark.sql.Observation` while the result is written, so the
metrics never cost a second pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.session import stage

ACTION = "__action"


def _expr(e: str | Column) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def _any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def dedupe_source(
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    *,
    on_duplicates: str = "error",
    sequence_by: Sequence[str] | None = None,
    what: str = "merge source",
) -> DataFrame:
    """One row per key, as a struct column ``s`` next to the keys.

    ``on_duplicates``: ``"error"`` fails the job (inside the plan) when a key has
    rows that differ; identical copies are collapsed (``dropDuplicates``
    semantics).  ``"latest"`` keeps the row with the greatest ``sequence_by``.
    Rows with a null key fail the job -- route them away first (quarantine).
    """
    keys = list(keys)
    payload = F.struct(*[F.col(c) for c in columns])
    if on_duplicates == "latest":
        if not sequence_by:
            raise ValueError("on_duplicates='latest' needs sequence_by")
        order = F.struct(*[F.col(c) for c in sequence_by])
        agg = source.groupBy(*keys).agg(F.max_by(payload, order).alias("s"), F.lit(True).alias("__ok"))
    elif on_duplicates == "error":
        agg = source.groupBy(*keys).agg(
            F.max(payload).alias("s"),
            (F.min(payload) == F.max(payload)).alias("__same"),
        )
        agg = agg.withColumn("__ok", F.coalesce(F.col("__same"), F.lit(True)))
    else:
        raise ValueError(f"unknown on_duplicates policy {on_duplicates!r}")
    msg = F.concat(F.lit(f"{what}: several different rows for key "), F.to_json(F.struct(*keys)))
    null_msg = F.lit(f"{what}: row with a null key; quarantine it before merging")
    check = (
        F.when(_any_null(keys), F.raise_error(null_msg).cast("boolean"))
        .when(F.col("__ok"), F.lit(True))
        .otherwise(F.raise_error(msg).cast("boolean"))
    )
    return agg.filter(check).select(*keys, "s")


def split_by_keys(target: DataFrame, source_keys: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(touched, untouched)`` target rows: ``LEFT SEMI`` / ``LEFT ANTI`` on the
    source's (unique, not null) keys; only the touched slice meets the merge
    logic.  The key set is the build side, so a small batch is broadcast and
    the target is read twice and never shuffled.  Target rows with a null key
    match nothing and stay untouched."""
    k = source_keys.select(*keys)
    return target.join(k, list(keys), "left_semi"), target.join(k, list(keys), "left_anti")


def _finish(df: DataFrame, columns: Sequence[str], observation: Observation | None) -> DataFrame:
    if observation is not None:
        df = df.observe(
            observation,
            F.count_if(F.col(ACTION) == "insert").alias("num_inserted"),
            F.count_if(F.col(ACTION) == "update").alias("num_updated"),
            F.count_if(F.col(ACTION) == "delete").alias("num_deleted"),
            F.count_if(F.col(ACTION) == "copy").alias("num_copied"),
        )
    return df.filter(F.col(ACTION) != "delete").select(*columns)


def upsert_all(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    on_duplicates: str = "error",
    sequence_by: Sequence[str] | None = None,
    observation: Observation | None = None,
    stage_source: bool = False,
) -> DataFrame:
    """M-01: matched keys take all source values, unmatched source rows are inserted.

    Only the target's columns are kept (extra source columns are ignored, as
    the gold upsert does); source values are cast to the target's types.
    """
    return upsert_mapped(
        target, source, keys,
        update_set={c: f"s.{c}" for c in target.columns if c not in keys},
        insert_values={c: f"s.{c}" for c in target.columns},
        on_duplicates=on_duplicates, sequence_by=sequence_by, observation=observation, stage_source=stage_source,
    )


def upsert_mapped(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_set: Mapping[str, str | Column] | None,
    insert_values: Mapping[str, str | Column] | None,
    *,
    matched_condition: str | Column | None = None,
    delete_condition: str | Column | None = None,
    on_duplicates: str = "error",
    sequence_by: Sequence[str] | None = None,
    observation: Observation | None = None,
    stage_source: bool = False,
) -> DataFrame:
    """M-02: ``MERGE`` with explicit ``SET`` / ``VALUES`` maps.

    Expressions see the source row as struct ``s`` and the target row as struct
    ``t`` (``"s.name"``, ``"coalesce(s.dob, t.dob)"``).  Target columns missing
    from ``update_set`` keep their value; missing from ``insert_values`` are null.
    ``update_set=None`` means no ``WHEN MATCHED`` clause, ``insert_values=None``
    no ``WHEN NOT MATCHED``.  ``delete_condition`` deletes matched rows (M-03).
    ``stage_source`` writes the de-duplicated source to the shared checkpoint
    folder first (an action).  Ask for it where the source is the result of a
    long plan: it is then computed once, and its real size, not an estimate,
    decides between broadcast and shuffle.
    """
    keys = list(keys)
    tcols = target.columns
    types = dict(target.dtypes)
    needed = sorted(set(source.columns))
    src = dedupe_source(source, keys, [c for c in needed if c not in keys] + keys,
                        on_duplicates=on_duplicates, sequence_by=sequence_by)
    if stage_source:
        src = stage(src, "merge-source")
    tgt = target.select(*keys, F.struct(*[F.col(c) for c in tcols]).alias("t"))
    # one read of the table: kept, updated and deleted rows (a null key matches nothing and is kept)
    j = tgt.join(src, keys, "left")
    if insert_values is not None:
        # a read of its keys only: the source rows that it has not
        known = target.select(*keys).join(src.select(*keys), keys, "left_semi").distinct()
        new = src.join(known, keys, "left_anti").select(*keys, F.lit(None).cast(tgt.schema["t"].dataType).alias("t"), "s")
        j = j.unionByName(new)

    has_t, has_s = F.col("t").isNotNull(), F.col("s").isNotNull()
    matched = has_t & has_s
    if matched_condition is not None:
        matched = matched & F.coalesce(_expr(matched_condition), F.lit(False))
    deleted = F.lit(False)
    if delete_condition is not None:
        deleted = has_t & has_s & F.coalesce(_expr(delete_condition), F.lit(False))

    do_update = matched & F.lit(update_set is not None) & ~deleted
    do_insert = ~has_t & has_s & F.lit(insert_values is not None)
    upd, ins = dict(update_set or {}), dict(insert_values or {})

    out = []
    for c in tcols:
        keep = F.col(f"t.{c}")
        u = _expr(upd[c]).cast(types[c]) if c in upd else keep
        i = _expr(ins[c]).cast(types[c]) if c in ins else F.lit(None).cast(types[c])
        if c in keys:
            u, keep = F.col(c), F.col(c)
            i = _expr(ins[c]).cast(types[c]) if c in ins else F.col(c)
        out.append(F.when(do_update, u).when(do_insert, i).otherwise(keep).alias(c))
    action = (
        F.when(deleted, "delete").when(do_update, "update").when(do_insert, "insert")
        .otherwise("copy")
    )
    return _finish(j.select(*out, action.alias(ACTION)), tcols, observation)


def merge_delete(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    target_condition: str | Column | None = None,
    *,
    stage_source: bool = False,
) -> DataFrame:
    """M-03: remove target rows whose key is in ``source`` and that satisfy
    ``target_condition`` (``WHEN MATCHED AND cond THEN DELETE``).

    ``target LEFT ANTI distinct(source keys)`` with the condition inside the
    join: rows failing the condition find no partner and are kept.  The
    distinct is partially aggregated, so a skewed source key is harmless; a
    small key set is broadcast and the target is not shuffled.
    """
    keys = list(keys)
    k = source.select(*[F.col(c).alias(f"__k_{c}") for c in keys]).distinct()
    if stage_source:
        k = stage(k, "merge-delete-keys")
    cond = reduce(lambda a, b: a & b, [target[c] == k[f"__k_{c}"] for c in keys])
    if target_condition is not None:
        cond = cond & _expr(target_condition)
    return target.join(k, cond, "left_anti")


def merge_conflicts(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M-04 report: keys matched by several *different* source rows."""
    keys = list(keys)
    payload = F.struct(*[F.col(c) for c in source.columns if c not in keys])
    return (
        source.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"), (F.min(payload) != F.max(payload)).alias("__diff"))
        .filter(F.col("__diff"))
        .drop("__diff")
    )
