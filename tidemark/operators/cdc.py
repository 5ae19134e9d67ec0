"""Change-data capture apply, type 1 and type 2 (M-06, M-07).

Type 1 is one aggregate: per key ``max_by(row, (sequence, tiebreak..., source))``.
``max_by`` is partially aggregated before the shuffle, so a key holding a
third of all changes still sends one row per map task.

Type 2 is one window pass: over (key, order) every row sees the tracked values
of its neighbours, the last row of each run is kept, its start is the last
opening row so far and its end the sequence of the row after it.  One scan, one
exchange of the rows, one sort.

A key with ``hot_key_rows`` changes or more would still be one task, so:

* a key-only count first finds the hot keys (a table, never brought to the driver;
  it reads the key columns only);
* their changes are cut into ranges of (key, order) and sorted, so any type of
  sequence works, equal stamps are split by the tiebreak, and a hot key is spread
  over many tasks;
* windows run per (range, key); one row per (range, key) -- first and last tracked
  values and order, last opening row -- tells the rows at a range's ends what
  stands beside them in the next one.

All variants are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.order import PART, POS, sorted_parts
from tidemark.session import stage

START, END = "__START_AT", "__END_AT"
TOMBSTONE = "__deleted"
KEY = "__k"
HOT_KEY_ROWS = 1 << 20


def _check(ok: Column, message: Column | str) -> Column:
    msg = F.lit(message) if isinstance(message, str) else message
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(msg).cast("boolean"))


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` where null equals null (keys may be null in change feeds)."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = None
    for c in on:
        term = left[c].eqNullSafe(r[f"__r_{c}"])
        cond = term if cond is None else cond & term
    return left.join(r, cond, how).drop(*[f"__r_{c}" for c in on])


def scd1(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    *,
    tiebreak: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    delete_when: str | Column | None = None,
    target: DataFrame | None = None,
    keep_tombstones: bool = False,
) -> DataFrame:
    """M-06: latest row per key by (``sequence_by``, ``tiebreak``...).

    With ``target`` (the stored state, same columns) a change replaces the
    stored row only if its order is >= the stored one, so replays and late
    files are harmless.  Without ``tiebreak``, two *different* rows with the
    same greatest sequence for one key fail the job.  Rows matching
    ``delete_when`` delete the key when they win.  ``keep_tombstones`` keeps a
    winning delete as a row flagged ``__deleted`` instead of dropping it: a
    stored state needs it so that a *late*, older change cannot bring the key
    back (a ``target`` may carry such a ``__deleted`` column).
    """
    keys = list(keys)
    order_cols = [sequence_by, *tiebreak]
    cols = list(columns) if columns is not None else [c for c in changes.columns if c not in keys]
    for c in order_cols:
        if c not in cols:
            cols.append(c)
    dele = (F.expr(delete_when) if isinstance(delete_when, str) else delete_when) if delete_when is not None else F.lit(False)
    src = changes.select(*keys, *cols, F.coalesce(dele, F.lit(False)).alias("__del"), F.lit(1).alias("__src"))
    if target is not None:
        stored_del = F.coalesce(F.col(TOMBSTONE), F.lit(False)) if TOMBSTONE in target.columns else F.lit(False)
        src = target.select(*keys, *cols, stored_del.alias("__del"), F.lit(0).alias("__src")).unionByName(src)
    payload = F.struct(*[F.col(c) for c in cols], F.col("__del"))
    order = F.struct(*[F.col(c) for c in order_cols], F.col("__src"))
    aggs = [F.max_by(payload, order).alias("r")]
    if not tiebreak:
        h = F.xxhash64(payload)
        aggs += [F.max(F.struct(order.alias("o"), h.alias("h"))).alias("__hi"),
                 F.max(F.struct(order.alias("o"), F.bitwise_not(h).alias("h"))).alias("__lo")]
    out = src.groupBy(*keys).agg(*aggs)
    if not tiebreak:
        tie = F.col("__hi.h") != F.bitwise_not(F.col("__lo.h"))
        out = out.filter(_check(~tie, F.concat(F.lit("scd1: equal sequence for different rows of key "),
                                                 F.to_json(F.struct(*keys)), F.lit("; pass a tiebreak"))))
    if keep_tombstones:
        return out.select(*keys, *[F.col(f"r.{c}").alias(c) for c in cols], F.col("r.__del").alias(TOMBSTONE))
    return out.filter(~F.col("r.__del")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in cols])


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    *,
    track_columns: Sequence[str] | None = None,
    tiebreak: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    chunk: Column | None = None,
    hot_key_rows: int = HOT_KEY_ROWS,
    start_order_col: str | None = None,
    split_hot_keys: bool = True,
) -> DataFrame:
    """M-07: validity intervals per key.

    Changes are ordered per key by (``sequence_by``, ``tiebreak``...); a row
    opens a new version when any tracked column differs (null-safely) from the
    previous row, otherwise its values replace those of the open version.
    Output: keys, the other columns as of the last row of each version,
    ``__START_AT`` (first sequence of the version) and ``__END_AT`` (start of
    the next version, null while open).  Default tracked columns: all but keys
    and the order columns.  Equal sequences for one key without a tiebreak fail.
    ``start_order_col`` also returns each version's first (sequence,
    tiebreak...) as a struct -- what incremental maintenance needs to cut a
    key's history exactly at a version boundary.
    """
    keys = list(keys)
    order_cols = [sequence_by, *tiebreak]
    cols = list(columns) if columns is not None else [c for c in changes.columns if c not in keys]
    for c in order_cols:
        if c not in cols:
            cols.append(c)
    track = list(track_columns) if track_columns is not None else [c for c in cols if c not in order_cols]
    args = (keys, sequence_by, cols, track, order_cols, bool(tiebreak), start_order_col)
    if chunk is not None:
        return _scd2_chunked(changes, *args, chunk=chunk)
    if not split_hot_keys:
        return _scd2_one_pass(changes, *args)
    kstruct = F.struct(*[F.col(k) for k in keys])
    hot = stage(changes.groupBy(kstruct.alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
                .filter(F.col("__n") >= hot_key_rows), "scd2-hot-keys")
    if hot.limit(1).count() == 0:
        return _scd2_one_pass(changes, *args)
    probe = changes.withColumn("__k", kstruct)
    hot_part = probe.join(hot.select("__k"), "__k", "left_semi").drop("__k")
    cold_part = probe.join(hot.select("__k"), "__k", "left_anti").drop("__k")
    return _scd2_one_pass(cold_part, *args).unionByName(_scd2_ranges(hot_part, *args))


def _ordered(changes: DataFrame, keys: list[str], cols: list[str], track: list[str], order_cols: list[str],
             *more: Column) -> DataFrame:
    """Key, tracked values and order as one struct each: a struct is never null
    and compares null fields as equal, so null keys and values behave like others.
    Changes that bring the struct of the keys as ``__k`` keep it, and with it
    the partitions of a join on it."""
    brought = changes.schema[KEY].dataType if KEY in changes.columns and KEY not in keys else None
    has_key = isinstance(brought, T.StructType) and brought.names == keys
    key = F.col(KEY) if has_key else F.struct(*[F.col(k) for k in keys]).alias(KEY)
    return changes.select(
        key, *cols,
        (F.struct(*[F.col(c) for c in track]) if track else F.struct(F.lit(0).alias("_"))).alias("__tv"),
        F.struct(*[F.col(c) for c in order_cols]).alias("__o"), *more)


def _no_equal_sequence(df: DataFrame, w, sequence_by: str) -> DataFrame:
    return (df.withColumn("__first", F.row_number().over(w) == 1).withColumn("__prev_seq", F.lag(sequence_by).over(w))
            .filter(_check(F.col("__first") | ~F.col(sequence_by).eqNullSafe(F.col("__prev_seq")),
                           F.concat(F.lit("scd2: equal sequence for one key "), F.to_json("__k"), F.lit("; pass a tiebreak"))))
            .drop("__first", "__prev_seq"))


def _scd2_one_pass(
    changes: DataFrame,
    keys: list[str],
    sequence_by: str,
    cols: list[str],
    track: list[str],
    order_cols: list[str],
    has_tiebreak: bool,
    start_order_col: str | None,
) -> DataFrame:
    """Type 2 with every key in one window partition."""
    seq_type = changes.schema[sequence_by].dataType.simpleString()
    df = _ordered(changes, keys, cols, track, order_cols)
    w = Window.partitionBy("__k").orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])
    if not has_tiebreak:
        df = _no_equal_sequence(df, w, sequence_by)
    df = (df.withColumn("__before", F.lag("__tv").over(w)).withColumn("__after", F.lead("__tv").over(w))
          .withColumn("__next", F.lead("__o").over(w)))
    # neighbours are structs, null only at the ends of a key
    opens = F.col("__before").isNull() | ~F.col("__tv").eqNullSafe(F.col("__before"))
    closes = F.col("__after").isNull() | ~F.col("__tv").eqNullSafe(F.col("__after"))
    df = df.withColumn("__start", F.last(F.when(opens, F.col("__o")), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).filter(closes)
    extra = [F.col("__start").alias(start_order_col)] if start_order_col else []
    return df.select(
        *[F.col(f"__k.{k}").alias(k) for k in keys], *cols,
        F.col(f"__start.{sequence_by}").cast(seq_type).alias(START),
        F.col(f"__next.{sequence_by}").cast(seq_type).alias(END), *extra)


def _scd2_ranges(
    changes: DataFrame,
    keys: list[str],
    sequence_by: str,
    cols: list[str],
    track: list[str],
    order_cols: list[str],
    has_tiebreak: bool,
    start_order_col: str | None,
) -> DataFrame:
    """Type 2 over ranges of (key, order): no task holds a whole hot key."""
    seq_type = changes.schema[sequence_by].dataType.simpleString()
    df = sorted_parts(_ordered(changes, keys, cols, track, order_cols),
                      ["__k", *[F.col(c).asc_nulls_first() for c in order_cols]], name="scd2-ranges")
    w = Window.partitionBy(PART, "__k").orderBy(POS)
    df = (df.withColumn("__before", F.lag("__tv").over(w)).withColumn("__after", F.lead("__tv").over(w))
          .withColumn("__prev", F.lag("__o").over(w)).withColumn("__next", F.lead("__o").over(w)))
    inner = F.col("__before").isNotNull() & ~F.col("__tv").eqNullSafe(F.col("__before"))
    df = df.withColumn("__opened", F.last(F.when(inner, F.col("__o")), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    # one row per (range, key): a key has one more than the ranges it reaches into
    ends = df.groupBy(PART, "__k").agg(
        F.min_by("__tv", POS).alias("__first_tv"), F.max_by("__tv", POS).alias("__last_tv"),
        F.min_by("__o", POS).alias("__first_o"), F.max_by("__o", POS).alias("__last_o"),
        F.max_by("__opened", POS).alias("__last_open"))
    over = Window.partitionBy("__k").orderBy(PART)
    ends = (ends.withColumn("__tv_before", F.lag("__last_tv").over(over)).withColumn("__o_before", F.lag("__last_o").over(over))
            .withColumn("__tv_after", F.lead("__first_tv").over(over)).withColumn("__o_after", F.lead("__first_o").over(over)))
    first_opens = F.col("__tv_before").isNull() | ~F.col("__first_tv").eqNullSafe(F.col("__tv_before"))
    ends = ends.withColumn("__own", F.when(first_opens, F.col("__first_o")))
    carried = F.last(F.coalesce("__last_open", "__own"), ignorenulls=True).over(
        over.rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.withColumn("__from", F.coalesce("__own", carried)).select(
        PART, "__k", "__tv_before", "__o_before", "__tv_after", "__o_after", "__from")

    df = df.join(ends, [PART, "__k"])
    if not has_tiebreak:
        prev = F.coalesce("__prev", "__o_before")
        df = df.filter(_check(prev.isNull() | ~F.col(sequence_by).eqNullSafe(prev[sequence_by]),
                              F.concat(F.lit("scd2: equal sequence for one key "), F.to_json("__k"), F.lit("; pass a tiebreak"))))
    after = F.coalesce("__after", "__tv_after")
    start, following = F.coalesce("__opened", "__from"), F.coalesce("__next", "__o_after")
    extra = [start.alias(start_order_col)] if start_order_col else []
    return df.filter(after.isNull() | ~F.col("__tv").eqNullSafe(after)).select(
        *[F.col(f"__k.{k}").alias(k) for k in keys], *cols, start[sequence_by].cast(seq_type).alias(START),
        following[sequence_by].cast(seq_type).alias(END), *extra)


def _scd2_chunked(
    changes: DataFrame,
    keys: list[str],
    sequence_by: str,
    cols: list[str],
    track: list[str],
    order_cols: list[str],
    has_tiebreak: bool,
    start_order_col: str | None,
    *,
    chunk: Column,
) -> DataFrame:
    """Type 2 with runs numbered per (key, chunk) and stitched by the chunk summary."""
    seq_type = changes.schema[sequence_by].dataType.simpleString()
    df = _ordered(changes, keys, cols, track, order_cols, F.struct(chunk.alias("c")).alias("__c"))
    w1 = Window.partitionBy("__k", "__c").orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])
    prev_tv = F.lag("__tv").over(w1)
    df = df.withColumn("__rn", F.row_number().over(w1)).withColumn(
        "__new", F.when(F.col("__rn") == 1, 0).when(~F.col("__tv").eqNullSafe(prev_tv), 1).otherwise(0))
    if not has_tiebreak:
        df = _no_equal_sequence(df, w1, sequence_by)
    df = df.withColumn("__j", F.sum("__new").over(w1.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    payload = F.struct(*[F.col(c) for c in cols])
    # runs inside a chunk; same partitioning as the window, no exchange
    local = df.groupBy("__k", "__c", "__j").agg(
        F.min("__o").alias("__first_o"),
        F.max("__o").alias("__last_o"),
        F.max_by(payload, F.col("__o")).alias("__p"),
        F.max_by("__tv", F.col("__o")).alias("__tv"),
    )
    # the per-chunk runs feed the summary and the join back: stage them
    # once (shared checkpoint folder) instead of recomputing the window
    local = stage(local, "scd2-local-runs")
    # one row per (key, chunk): does its first run continue the previous chunk?
    summary = local.groupBy("__k", "__c").agg(
        (F.max("__j") + 1).alias("__n_local"),
        F.min_by("__tv", F.col("__j")).alias("__first_tv"),
        F.max_by("__tv", F.col("__j")).alias("__last_tv"),
    )
    w2 = Window.partitionBy("__k").orderBy(F.col("__c").asc_nulls_first())
    first_flag = F.when(F.row_number().over(w2) == 1, 1).when(
        ~F.col("__first_tv").eqNullSafe(F.lag("__last_tv").over(w2)), 1).otherwise(0)
    summary = summary.withColumn("__ff", first_flag).withColumn("__runs", F.col("__ff") + F.col("__n_local") - 1)
    summary = summary.withColumn(
        "__off", F.sum("__runs").over(w2.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__runs")
    ).select("__k", "__c", "__ff", "__off")

    tagged = local.join(summary, ["__k", "__c"]).withColumn("__run", F.col("__off") + F.col("__ff") + F.col("__j"))

    # Each local run also reports its start to the run before it: one
    # aggregate gives every run its start, its last row and its end, with no
    # self-join and no whole-key window.
    none_o = F.lit(None).cast(local.schema["__first_o"].dataType)
    own = tagged.select("__k", "__run", "__first_o", "__last_o", "__p", none_o.alias("__next"))
    succ = tagged.select("__k", (F.col("__run") - 1).alias("__run"), none_o.alias("__first_o"),
                         none_o.alias("__last_o"), F.lit(None).cast(local.schema["__p"].dataType).alias("__p"),
                         F.col("__first_o").alias("__next"))
    runs = (
        own.unionByName(succ)
        .groupBy("__k", "__run")
        .agg(F.min("__first_o").alias("__first_o"), F.max_by("__p", F.col("__last_o")).alias("__p"),
             F.min("__next").alias("__next_o"))
        .filter(F.col("__first_o").isNotNull())
    )
    extra = [F.col("__first_o").alias(start_order_col)] if start_order_col else []
    return runs.select(
        *[F.col(f"__k.{k}").alias(k) for k in keys], *[F.col(f"__p.{c}").alias(c) for c in cols],
        F.col(f"__first_o.{sequence_by}").cast(seq_type).alias(START),
        F.col(f"__next_o.{sequence_by}").cast(seq_type).alias(END),
        *extra,
    )


def scd2_windowed(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    *,
    track_columns: Sequence[str] | None = None,
    tiebreak: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Type 2 with whole-key windows for every key (a hot key is one task)."""
    return scd2(changes, keys, sequence_by, track_columns=track_columns, tiebreak=tiebreak,
                columns=columns, split_hot_keys=False)


def apply_changes(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    scd_type: int | str = 1,
    *,
    track_columns: Sequence[str] | None = None,
    tiebreak: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    delete_when: str | Column | None = None,
    target: DataFrame | None = None,
    stored_as_scd_type: int | str | None = None,
    track_history_column_list: Sequence[str] | None = None,
) -> DataFrame:
    """Single entry point with the declarative CDC call's arguments
    (``stored_as_scd_type`` and ``track_history_column_list`` are accepted
    under those names too)."""
    if stored_as_scd_type is not None:
        scd_type = stored_as_scd_type
    if track_history_column_list is not None:
        track_columns = track_history_column_list
    if str(scd_type) == "1":
        return scd1(changes, keys, sequence_by, tiebreak=tiebreak, columns=columns,
                    delete_when=delete_when, target=target)
    if str(scd_type) == "2":
        if delete_when is not None or target is not None:
            raise ValueError("scd2 recomputes from the change log: pass the full log, no target or deletes")
        return scd2(changes, keys, sequence_by, track_columns=track_columns, tiebreak=tiebreak, columns=columns)
    raise ValueError(f"scd_type must be 1 or 2, not {scd_type!r}")
