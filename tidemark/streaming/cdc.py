"""Streaming CDC apply into a key-bucketed state (T-05, T-06).

Type 1: each micro-batch merges its rows with the stored rows of the buckets
it touches (``scd1`` with ``target``): a stored row is replaced only by an
equal-or-later sequence, so late files and replays cannot move a key back.

Type 2: a collapsed history cannot absorb an out-of-order change (``A@1,
A@3`` stored as one version cannot become ``A, B, A`` when ``B@2`` arrives),
so every micro-batch first appends its rows to a bronze change log
(partitioned by bucket and batch id, overwritten per batch id so a replay
writes the same files again) and then recomputes the history of the *affected
keys only*, and for each of them only from the version that holds its earliest
new change.  Both run through :class:`BucketedState`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cdc import END, HOT_KEY_ROWS, KEY, START, TOMBSTONE, scd1, scd2
from tidemark.session import stage
from tidemark.streaming.ingest import run_available
from tidemark.streaming.state import BUCKET, BucketedState, merge_in_place, stream_writer

BATCH = "__batch"
START_O = "__START_ORDER"


def _cols(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None) -> list[str]:
    cols = list(columns) if columns is not None else [c for c in df.columns if c not in keys]
    for c in order:
        if c not in cols:
            cols.append(c)
    return cols


def stream_scd1(stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str], sequence_by: str, *,
                tiebreak: Sequence[str] = (), columns: Sequence[str] | None = None,
                delete_when: str | None = None, n_buckets: int = 64) -> BucketedState:
    """Type 1 into a bucketed state: each micro-batch merges its rows with the
    stored rows of the buckets it touches; a stored row is replaced only by an
    equal-or-later sequence.  Rows matching ``delete_when`` delete their key
    when they win; the delete is kept as a hidden tombstone, so a late change
    with an older sequence cannot bring the key back."""
    keys = list(keys)
    cols = _cols(stream, keys, [sequence_by, *tiebreak], columns)
    schema = T.StructType([stream.schema[c] for c in [*keys, *cols]]
                          + ([T.StructField(TOMBSTONE, T.BooleanType(), True)] if delete_when is not None else []))
    state = BucketedState(root, keys, schema, n_buckets, tombstone_col=TOMBSTONE if delete_when is not None else None)

    writer = stream_writer(checkpoint)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if state.committed(spark, batch_id, writer):
            return
        b = state.with_bucket(batch).persist()
        try:
            touched = state.bucket_ids(b)

            def compute() -> DataFrame:
                cur = state.read(spark, touched)
                # deletes stay as tombstones so a late, older change cannot revive the key
                return scd1(b, keys, sequence_by, tiebreak=tiebreak, columns=[*cols, BUCKET],
                            delete_when=delete_when, target=cur, keep_tombstones=delete_when is not None)
            state.apply(spark, batch_id, compute, touched=touched, writer=writer)
        finally:
            b.unpersist()

    run_available(stream, checkpoint, sink=apply)
    return state


def stream_scd2(stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str], sequence_by: str, *,
                track_columns: Sequence[str] | None = None, tiebreak: Sequence[str] = (),
                columns: Sequence[str] | None = None, n_buckets: int = 64,
                current_root: str | None = None) -> BucketedState:
    """Incremental type 2.  Per key touched by a micro-batch, only the log
    rows from the first row of the stored version that contains the batch's
    earliest change onwards are recomputed; earlier versions cannot change (no
    new row precedes them) and are kept as stored.  What is recomputed follows
    the depth of late arrival; the touched buckets are read and written whole.

    ``current_root`` also maintains the current snapshot (open versions only,
    T-07) as its own bucketed table, refreshed for the touched buckets at the
    end of every micro-batch under the same batch id.  Each table has its own
    commit marker: a replay after a crash between the two skips the state, which
    has the batch, and still writes the snapshot, which has not.
    """
    keys = list(keys)
    order_cols = [sequence_by, *tiebreak]
    cols = _cols(stream, keys, order_cols, columns)
    order_type = T.StructType([stream.schema[c] for c in order_cols])
    out_schema = T.StructType(
        [stream.schema[c] for c in [*keys, *cols]]
        + [T.StructField(START, stream.schema[sequence_by].dataType, True),
           T.StructField(END, stream.schema[sequence_by].dataType, True),
           T.StructField(START_O, order_type, True)]
    )
    state = BucketedState(f"{root}/state", keys, out_schema, n_buckets)
    current = BucketedState(current_root, keys, out_schema, n_buckets) if current_root else None
    bronze = f"{root.rstrip('/')}/bronze"
    log_schema = T.StructType([stream.schema[c] for c in [*keys, *cols]]
                              + [T.StructField(BUCKET, T.IntegerType(), True), T.StructField(BATCH, T.StringType(), True)])

    writer = stream_writer(checkpoint)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        todo = not state.committed(spark, batch_id, writer)
        todo_current = current is not None and not current.committed(spark, batch_id, writer)
        if not todo and not todo_current:
            return
        b = state.with_bucket(batch.select(*keys, *cols)).withColumn(BATCH, F.lit(f"{writer}-{batch_id}"))
        touched = state.bucket_ids(b)
        if todo:
            (b.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(BUCKET, BATCH).parquet(bronze))

        def compute() -> DataFrame:
            # keys compared as one struct: null key fields match each other
            kcol = F.struct(*[F.col(k) for k in keys]).alias(KEY)
            order = F.struct(*[F.col(c) for c in order_cols])
            log = spark.read.schema(log_schema).parquet(bronze)
            mine = log.filter(F.col(BATCH) == f"{writer}-{batch_id}")
            first_new = mine.groupBy(kcol).agg(F.min(order).alias("__m"))
            stored = state.read(spark, touched).select("*", kcol)
            # start of the stored version holding the earliest new change (null: none -> whole key)
            cut = (stored.select(KEY, START_O).join(first_new, KEY)
                   .groupBy(KEY).agg(F.max(F.when(F.col(START_O) <= F.col("__m"), F.col(START_O))).alias("__cut"),
                                     F.lit(True).alias("__known")))
            # one row per key of the batch, written once: the bound, the rows to
            # recompute and those to keep all need it
            affected = stage(first_new.join(cut, KEY, "left").select(KEY, "__cut", "__m", "__known"), "scd2-affected")
            # Lower bound of the rows any affected key needs: its cut, or for a
            # key never seen before its first change (all its rows are in this
            # batch).  A late change older than every stored version needs the
            # key's whole history: no bound then.  One value to the driver,
            # pushed into the scan so old bronze files are skipped by their
            # statistics.
            need = F.when(F.col("__cut").isNotNull(), F.col("__cut")).when(F.col("__known").isNull(), F.col("__m"))
            lo = affected.agg(F.count_if(need.isNull()).alias("unbounded"), F.min(need).alias("lo")).first()
            scan = log.filter(F.col(BUCKET).isin(touched))
            if lo["unbounded"] == 0 and lo["lo"] is not None and lo["lo"][sequence_by] is not None:
                scan = scan.filter(F.col(sequence_by) >= F.lit(lo["lo"][sequence_by]))
            affected = affected.select(KEY, "__cut")
            # the key column stays: the window finds the rows where the join has put them
            suffix = (scan.select("*", kcol)
                      .join(affected, KEY)
                      .filter(F.col("__cut").isNull() | (order >= F.col("__cut")))
                      .drop("__cut", BATCH))
            # a key is no larger than its bucket: without a bucket of a hot key's
            # size the keys need not be counted
            hot = scan.groupBy(BUCKET).count().filter(F.col("count") >= HOT_KEY_ROWS).limit(1).count() > 0
            rebuilt = scd2(suffix, keys, sequence_by, track_columns=track_columns, tiebreak=tiebreak,
                           columns=[*cols, BUCKET], start_order_col=START_O, hot_key_rows=HOT_KEY_ROWS,
                           split_hot_keys=hot)
            kept = (stored.join(affected.withColumn("__hit", F.lit(True)), KEY, "left")
                    .filter(F.col("__hit").isNull() | (F.col("__cut").isNotNull() & (F.col(START_O) < F.col("__cut")))))
            out = [*keys, *cols, START, END, START_O, BUCKET]
            return kept.select(*out).unionByName(rebuilt.select(*out))

        if todo:
            state.apply(spark, batch_id, compute, touched=touched, writer=writer)
        if todo_current:
            current.apply(spark, batch_id, lambda: state.read(spark, touched).filter(F.col(END).isNull()),
                          touched=touched, writer=writer)

    run_available(stream, checkpoint, sink=apply)
    return state


def purge_tombstones(spark, state: BucketedState, sequence_by: str, older_than, batch_id: int) -> None:
    """Drop delete tombstones whose sequence is below ``older_than`` -- once no
    change older than that can still arrive.  Only buckets that hold such a
    tombstone are rewritten (one replay-safe commit under ``batch_id``);
    buckets left empty are removed."""
    if not state.tombstone_col:
        return
    old = F.col(state.tombstone_col) & (F.col(sequence_by) < F.lit(older_than))
    touched = state.bucket_ids(state.read(spark).filter(old))
    if not touched:
        return
    state.apply(spark, batch_id, lambda: state.read(spark, touched).filter(~old), touched=touched)


def stream_merge(stream: DataFrame, table: BucketedState, checkpoint: str, merge, **kwargs) -> BucketedState:
    """Any pure merge ``merge(target, batch, **kwargs)`` as a stream: every
    micro-batch is one ``merge_in_place`` commit on the bucketed table, keyed
    by the batch id, so a replayed micro-batch is skipped."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge_in_place(batch.sparkSession, table, batch, merge, batch_id, writer=stream_writer(checkpoint), **kwargs)

    run_available(stream, checkpoint, sink=apply)
    return table
