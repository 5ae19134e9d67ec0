"""History-keeping merges and views over history (M-05, M-08 .. M-12).

Two-version table model (M-05): per key at most one ``Active`` row (``eskey``
0) and one ``InActive`` row (``eskey`` 1), with ``start_date``, ``end_date``
and ``created_date``, plus an origin column (``file_name``).

Plan: the batch is reduced to one row per key (partial + final aggregate,
which also enforces one batch row per key); the target is split against the
batch keys by ``LEFT SEMI`` / ``LEFT ANTI`` (the key set is the build side: a
small batch is broadcast and the target is scanned, not shuffled); untouched
rows are copied; the touched slice is pivoted to one row per key (``active``
and ``inactive`` structs) and left-joined to the batch, and each joined row
``inline``-s the 1 or 2 rows it contributes to the new state.  The reference
needed four joins and two actions for the same result.
"""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.compare import differs
from tidemark.functions.text import mask_email
from tidemark.functions.time import on_day
from tidemark.operators.merge import ACTION, dedupe_source, split_by_keys, upsert_all
from tidemark.session import stage

# Fixed values of the two-version model.
ACTIVE, INACTIVE = "Active", "InActive"
FAR_END = "9999-12-31 00:00:00"


def _ts(v: str | Column, dtype: str) -> Column:
    return (F.lit(v) if isinstance(v, str) else v).cast(dtype)


def _check(ok: Column, message: str) -> Column:
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))


def two_version_merge(
    target: DataFrame,
    batch: DataFrame,
    *,
    key: str = "id",
    values: Sequence[str] = ("name", "dob", "gender", "country", "email"),
    origin: str = "file_name",
    run_ts: str | Column | None = None,
    compat: bool = False,
    on_duplicates: str = "error",
    sequence_by: Sequence[str] | None = None,
    observation: Observation | None = None,
    stage_source: bool = False,
) -> DataFrame:
    """M-05: apply ``batch`` to a two-version table; returns the new table state.

    ``compat=True`` reproduces the reference exactly: the compared columns
    include the origin file name, a key that already has an ``InActive`` row
    always counts as changed, the new version keeps the old ``start_date`` /
    ``end_date``, and an existing ``InActive`` row keeps its dates while taking
    the old active values.  ``compat=False`` (default) compares only ``values``,
    starts the new version at ``run_ts`` and closes the old one at ``run_ts``.
    Unchanged keys are copied as they are in both modes.  A key whose only stored
    row is ``InActive`` is not touched by ``compat=True``; by default it gets the
    incoming row as its ``Active`` version and keeps the ``InActive`` one.
    """
    values = list(values)
    tcols = target.columns
    types = dict(target.dtypes)
    ts_type = types["start_date"]
    run = _ts(run_ts, ts_type) if run_ts is not None else F.current_timestamp().cast(ts_type)
    far = _ts(FAR_END, ts_type)
    payload = [c for c in tcols if c != key]

    b_cols = [c for c in (*values, origin) if c in batch.columns]
    b_agg = dedupe_source(batch.select(key, *b_cols), [key], b_cols,
                          on_duplicates=on_duplicates, sequence_by=sequence_by, what="two-version batch")
    if stage_source:
        b_agg = stage(b_agg, "two-version-batch")
    # keys absent from the batch are copied untouched; only the touched slice is pivoted
    touched, untouched = split_by_keys(target, b_agg, [key])

    row = F.struct(*[F.col(c) for c in payload])
    st = F.col("status")
    t_agg = (
        touched.groupBy(key)
        .agg(
            F.max(F.when(st == ACTIVE, row)).alias("a"),
            F.max(F.when(st == INACTIVE, row)).alias("i"),
            F.count_if(st == ACTIVE).alias("n_a"),
            F.count_if(st == INACTIVE).alias("n_i"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter(_check((F.col("n_a") <= 1) & (F.col("n_i") <= 1) & (F.col("n") == F.col("n_a") + F.col("n_i")),
                       "two-version target: more than one Active/InActive row, or unknown status, for a key"))
        .select(key, "a", "i")
    )
    j = b_agg.join(t_agg, key, "left")

    a, i, b = F.col("a"), F.col("i"), F.col("s")
    cmp = values + ([origin] if compat else [])
    diff = differs([F.col(f"a.{c}") for c in cmp], [F.col(f"s.{c}") for c in cmp])
    if compat:
        changed = a.isNotNull() & b.isNotNull() & (i.isNotNull() | diff)
    else:
        changed = a.isNotNull() & b.isNotNull() & diff

    def make(vals: dict[str, Column], action: str) -> Column:
        return F.struct(*[vals[c].cast(types[c]).alias(c) for c in tcols], F.lit(action).alias(ACTION))

    def stored(s: Column) -> Column:
        return F.when(s.isNotNull(), make({key: F.col(key), **{c: s[c] for c in payload}}, "copy"))

    def from_batch(**system: Column) -> dict[str, Column]:
        d = {key: F.col(key), **{c: F.col(f"s.{c}") for c in values}}
        d[origin] = F.col(f"s.{origin}") if origin in b_cols else F.col(f"a.{origin}")
        d.update(system)
        return d

    new_row = make(from_batch(eskey=F.lit(0), status=F.lit(ACTIVE), start_date=run, end_date=far, created_date=run), "insert")
    if compat:
        act_start, act_end = F.col("a.start_date"), F.col("a.end_date")
        old_start = F.coalesce(F.col("i.start_date"), F.col("a.start_date"))
        old_end = F.coalesce(F.col("i.end_date"), run)
    else:
        act_start, act_end = run, far
        old_start, old_end = F.col("a.start_date"), run
    new_version = make(from_batch(eskey=F.lit(0), status=F.lit(ACTIVE), start_date=act_start, end_date=act_end,
                                  created_date=run), "update")
    old_vals = {key: F.col(key), **{c: F.col(f"a.{c}") for c in payload}}
    old_vals.update(eskey=F.lit(1), status=F.lit(INACTIVE), start_date=old_start, end_date=old_end, created_date=run)
    old_version = make(old_vals, "update")

    rows = (
        F.when(a.isNull() & (i.isNull() if compat else F.lit(True)), F.array_compact(F.array(new_row, stored(i))))
        .when(changed, F.array(new_version, old_version))
        .otherwise(F.array_compact(F.array(stored(a), stored(i))))
    )
    res = j.select(F.inline(rows)).unionByName(untouched.select(*tcols, F.lit("copy").alias(ACTION)))
    if observation is not None:
        res = res.observe(
            observation,
            F.count_if(F.col(ACTION) == "insert").alias("num_inserted"),
            F.count_if(F.col(ACTION) == "update").alias("num_updated"),
            F.count_if(F.col(ACTION) == "copy").alias("num_copied"),
        )
    return res.select(*tcols)


def two_version_changes(
    target: DataFrame,
    batch: DataFrame,
    *,
    key: str = "id",
    values: Sequence[str] = ("name", "dob", "gender", "country", "email"),
    origin: str = "file_name",
    compat: bool = True,
    stage_keys: bool = False,
) -> DataFrame:
    """C-01 against a whole two-version table, one row per batch row plus one
    per target-only key.

    ``compat=True`` follows the reference: ``New`` (key not in the table),
    ``Update`` (the key has an ``InActive`` row, or its active row differs
    null-safely in a value or the origin file name), else ``Exist`` (also every
    key only in the table).  ``compat=False`` compares ``values`` only and
    says ``new`` / ``update`` / ``unchanged`` / ``missing``.
    """
    values = list(values)
    labels = ("New", "Update", "Exist", "Exist") if compat else ("new", "update", "unchanged", "missing")
    cmp = values + ([origin] if compat else [])
    keys_df = batch.select(key).filter(F.col(key).isNotNull()).distinct()
    if stage_keys:
        keys_df = stage(keys_df, "two-version-change-keys")
    touched, untouched = split_by_keys(target, keys_df, [key])
    st = F.col("status")
    t_agg = touched.groupBy(key).agg(
        F.max(F.when(st == ACTIVE, F.struct(*[F.col(c) for c in cmp]))).alias("a"),
        F.max(st == INACTIVE).alias("has_i"),
    )
    j = batch.select(key, F.struct(*[F.col(c) for c in cmp]).alias("s")).join(t_agg, key, "left")
    diff = differs([F.col(f"a.{c}") for c in cmp], [F.col(f"s.{c}") for c in cmp])
    changed = (F.col("has_i") & F.lit(compat)) | (F.col("a").isNotNull() & diff)
    change = (F.when(F.col("has_i").isNull(), labels[0]).when(changed, labels[1]).otherwise(labels[2]))
    rest = untouched.select(key).distinct().select(key, F.lit(labels[3]).alias("change"))
    return j.select(key, change.alias("change")).unionByName(rest)


def versioned_history_merge(
    target: DataFrame,
    batch: DataFrame,
    *,
    key: str = "id",
    values: Sequence[str] = ("name", "mobile"),
    run_ts: str | Column | None = None,
    stage_source: bool = False,
) -> DataFrame:
    """M-08: version 0 = current, 1 = previous; every touched key gets both.

    Well-defined part of the versioned-history flow: the target must hold a single
    ``Active`` (version 0) row per key and nothing else (else the job fails);
    a batch key present in the target turns the stored row into version 1 /
    ``InActive`` and adds the batch row as version 0 / ``Active`` (changed or
    not, as in the reference); new keys get version 0; untouched rows are kept.
    ``datetime`` becomes ``run_ts`` on every row and ``status`` is recomputed from
    ``version`` (both as the reference does).
    """
    values = list(values)
    tcols = target.columns
    types = dict(target.dtypes)
    run = _ts(run_ts, types["datetime"]) if run_ts is not None else F.current_timestamp().cast(types["datetime"])
    b = dedupe_source(batch.select(key, *values), [key], values, what="versioned batch")
    if stage_source:
        b = stage(b, "versioned-batch")
    touched, untouched = split_by_keys(target, b, [key])
    t = (
        touched.groupBy(key)
        .agg(F.max(F.struct(*[F.col(c) for c in values])).alias("t"),
             F.count(F.lit(1)).alias("n"), F.count_if(F.col("version") != 0).alias("n_old"))
        .filter(_check((F.col("n") == 1) & (F.col("n_old") == 0),
                       "versioned target: expected exactly one version-0 row per key"))
        .select(key, "t")
    )
    j = b.join(t, key, "left")

    def make(src: str, version: int) -> Column:
        vals = {key: F.col(key), **{c: F.col(f"{src}.{c}") for c in values}}
        vals.update(version=F.lit(version), datetime=run, status=F.lit(ACTIVE if version == 0 else INACTIVE))
        return F.struct(*[vals[c].cast(types[c]).alias(c) for c in tcols])

    rows = F.when(F.col("t").isNull(), F.array(make("s", 0))).otherwise(F.array(make("s", 0), make("t", 1)))
    # untouched keys keep their version; datetime and status are restamped on every row
    rest = untouched.select(*[
        run.cast(types[c]).alias(c) if c == "datetime"
        else F.when(F.col("version") == 0, F.lit(ACTIVE)).otherwise(F.lit(INACTIVE)).cast(types[c]).alias(c)
        if c == "status" else F.col(c)
        for c in tcols
    ])
    return j.select(F.inline(rows)).unionByName(rest)


def versioned_history_runs(
    target: DataFrame,
    batches: Sequence[DataFrame],
    *,
    key: str = "id",
    values: Sequence[str] = ("name", "mobile"),
    run_ts: str | Column | None = None,
) -> DataFrame:
    """M-08, later runs: ``batches`` applied one after the other to a table that
    may hold history already, in one plan.

    Every run turns a key's current row into its previous one and prunes what was
    previous before, so after all runs a key holds the newest two of (rows of
    the batches, latest first; the stored ``Active`` row; the stored
    ``InActive`` row): version 0 / ``Active`` and version 1 / ``InActive``, each
    replacing the stored row of the same (key, status).  A key in no batch keeps
    its rows.  ``datetime`` becomes ``run_ts``, the time of the last run, and
    ``status`` follows from ``version`` on every row, as in a single run.

    A batch with different rows of one key, and a key with several stored rows
    of one status or with a version other than 0 and 1, fail the job.
    """
    values = list(values)
    tcols, types = target.columns, dict(target.dtypes)
    run = _ts(run_ts, types["datetime"]) if run_ts is not None else F.current_timestamp().cast(types["datetime"])
    row = F.struct(*[F.col(c) for c in values])
    tagged = None
    for r, batch in enumerate(batches):
        one = dedupe_source(batch.select(key, *values), [key], values, what=f"versioned batch {r}").select(
            key, F.struct(F.lit(r).alias("run"), *[F.col(f"s.{c}").cast(types[c]).alias(c) for c in values]).alias("v"))
        tagged = one if tagged is None else tagged.unionByName(one)
    if tagged is None:
        raise ValueError("no batch to apply")
    # at most one row a batch for a key
    new = tagged.groupBy(key).agg(F.slice(F.sort_array(F.collect_list("v"), asc=False), 1, 2).alias("new"))
    touched, untouched = split_by_keys(target, new, [key])
    current, old = F.col("version") == 0, F.col("version") == 1
    stored = F.struct(F.lit(-1).alias("run"), *[F.col(c) for c in values])
    t = (
        touched.groupBy(key)
        .agg(F.max(F.when(current, stored)).alias("a"), F.max(F.when(old, stored)).alias("i"),
             F.count_if(current).alias("n_a"), F.count_if(old).alias("n_i"), F.count(F.lit(1)).alias("n"))
        .filter(_check((F.col("n_a") <= 1) & (F.col("n_i") <= 1) & (F.col("n") == F.col("n_a") + F.col("n_i")),
                       "versioned target: several rows of one status, or an unknown version, for a key"))
        .select(key, "a", "i")
    )
    newest = F.slice(F.concat("new", F.array_compact(F.array("a", "i"))), 1, 2)
    rows = (new.join(t, key, "left").select(key, F.posexplode(newest).alias("version", "v"))
            .select(key, "version", *[F.col(f"v.{c}").alias(c) for c in values]))
    restamped = {"datetime": run, "status": F.when(F.col("version") == 0, ACTIVE).otherwise(INACTIVE)}

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*[restamped.get(c, F.col(c)).cast(types[c]).alias(c) for c in tcols])

    return shaped(rows).unionByName(shaped(untouched))


def current_snapshot(history: DataFrame, *, status_col: str = "status", day: str | Column | None = None,
                     day_col: str = "created_date", active: str = ACTIVE) -> DataFrame:
    """M-09: active rows, optionally only those created on ``day``.

    The reference tests "today" with a substring match on the timestamp text;
    here it is the half-open range ``[day, day + 1)`` so Parquet can prune.
    """
    out = history.filter(F.col(status_col) == active)
    if day is not None:
        out = out.filter(on_day(F.col(day_col), day))
    return out


def open_versions(history: DataFrame, end_col: str = "__END_AT") -> DataFrame:
    """Type 2 current state: versions whose interval is still open."""
    return history.filter(F.col(end_col).isNull())


def as_of(history: DataFrame, at: str | Column, *, start_col: str = "__START_AT", end_col: str = "__END_AT") -> DataFrame:
    """M-10: versions valid at ``at``: ``start <= at AND (end IS NULL OR at < end)``.

    A pure filter on the interval columns: pushed into the scan as
    ``start <= at`` and evaluated row-wise for the end.
    """
    dtype = dict(history.dtypes)[start_col]
    t = (F.lit(at) if isinstance(at, str) else at).cast(dtype)
    return history.filter((F.col(start_col) <= t) & (F.col(end_col).isNull() | (t < F.col(end_col))))


def close_open_intervals(history: DataFrame, *, end_col: str = "__END_AT", far: str = FAR_END,
                         compat: bool = False) -> DataFrame:
    """M-11: replace open ``end`` by a far date.

    The reference overwrites *every* end (closed ones too); that is a bug kept
    behind ``compat=True``.
    """
    dtype = dict(history.dtypes)[end_col]
    far_c = F.lit(far).cast(dtype)
    new_end = far_c if compat else F.coalesce(F.col(end_col), far_c)
    return history.withColumn(end_col, new_end)


def publish_masked_snapshot(
    history: DataFrame,
    gold: DataFrame,
    *,
    key: str = "id",
    email_col: str = "email",
    day: str | Column | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """M-12: active (and optionally created-today) rows -> masked e-mail -> upsert into gold.

    Gold has no ``eskey``; extra history columns are dropped by the upsert.
    """
    snap = current_snapshot(history, day=day)
    snap = snap.withColumn(email_col, mask_email(F.col(email_col)))
    return upsert_all(gold, snap, [key], observation=observation)

