"""Key-bucketed state table for streaming merges.

The state is Parquet partitioned by ``__bucket = pmod(xxhash64(keys), n)``.
A micro-batch touches only the buckets of its keys, so only those partitions
are read (partition pruning) and rewritten (dynamic partition overwrite).  A
batch whose keys fall into every bucket rewrites the whole table: choose the
number of buckets so that a batch's keys meet a small part of them.

Crash and replay safety (``foreachBatch`` is at-least-once):

1. the new content of the touched buckets is first written to
   ``_staging/<batch_id>`` (a complete, self-contained result);
2. the staged bucket folders replace the stored ones by rename;
3. ``_commits/<batch_id>`` is written last.

Commits are named by writer and batch id: loads, merges called by hand and each
stream checkpoint count for themselves, so none can be taken for another's
replay.  The number of buckets and the key types are stored with the table
(``_table``) and a mismatch is an error; keys are cast to the table's types
before they are bucketed, and a result with a bucket that the batch did not
touch is refused before anything moves.

A replayed batch id with a commit marker is skipped; one with a complete
staging copy but no marker redoes step 2 from the copy instead of
recomputing against a half-updated state; folders already moved are simply
no longer in staging.
"""

from __future__ import annotations

import datetime
import inspect
import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.audit import METRIC_NAMES
from tidemark.session import path_exists

BUCKET = "__bucket"


def bucket_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


_exists = path_exists


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, jvm = _fs(spark, path)
    out = fs.create(jvm.org.apache.hadoop.fs.Path(path), True)
    out.write(bytearray(text.encode()))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, jvm = _fs(spark, path)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(path))
    text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def observed(observation: Observation) -> dict:
    """What an observation saw; nothing if its part of the plan did not run
    (an empty result can be planned away with its metrics)."""
    try:
        return dict(observation.get)
    except Exception:  # noqa: BLE001 - metrics are facts about a run, never a reason to fail it
        return {}


class BucketedState:
    def __init__(self, root: str, keys: Sequence[str], schema: T.StructType, n_buckets: int = 64,
                 tombstone_col: str | None = None):
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.schema = schema
        self.n = n_buckets
        self.tombstone_col = tombstone_col

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    def with_bucket(self, df: DataFrame) -> DataFrame:
        """``df`` with its keys as the table's types (a key that does not fit
        is an error, never another key) and their bucket."""
        for k in self.keys:
            want = self.schema[k].dataType
            if df.schema[k].dataType != want:
                cast = F.col(k).try_cast(want)
                df = df.withColumn(k, F.when(F.col(k).isNull() | cast.isNotNull(), cast).otherwise(
                    F.raise_error(F.concat(F.lit(f"key {k} does not fit {want.simpleString()}: "),
                                           F.col(k).cast("string"))).cast(want)))
        return df.withColumn(BUCKET, bucket_of(self.keys, self.n))

    def check_layout(self, spark: SparkSession) -> None:
        """Store the layout on first use; refuse another one afterwards."""
        mine = json.dumps({"buckets": self.n, "keys": [[k, self.schema[k].dataType.simpleString()] for k in self.keys]})
        place = f"{self.root}/_table"
        if _exists(spark, place):
            stored = _read_text(spark, place)
            if stored != mine:
                raise ValueError(f"the table at {self.root} was written as {stored}, not {mine}")
            return
        _write_text(spark, place, mine)

    @property
    def stored_schema(self) -> T.StructType:
        fields = [f for f in self.schema.fields if f.name != BUCKET]
        return T.StructType(fields + [T.StructField(BUCKET, T.IntegerType(), True)])

    @staticmethod
    def bucket_ids(df: DataFrame) -> list[int]:
        """The distinct buckets of ``df`` -- at most ``n`` small integers, so
        bringing them to the driver is bounded."""
        return sorted(r[0] for r in df.select(BUCKET).distinct().collect())

    def read(self, spark: SparkSession, buckets: list[int] | None = None) -> DataFrame:
        """The state, or only the partitions of ``buckets``: a literal ``IN``
        list on the partition column, so the scan lists and reads only those
        folders (static partition pruning)."""
        if not _exists(spark, self.data):
            return spark.createDataFrame([], self.stored_schema)
        self.check_layout(spark)
        st = spark.read.schema(self.stored_schema).parquet(self.data)
        if buckets is not None:
            st = st.filter(F.col(BUCKET).isin(list(buckets)))
        return st

    def committed(self, spark: SparkSession, batch_id: int, writer: str = "merge") -> bool:
        return _exists(spark, f"{self.root}/_commits/{writer}-{batch_id}")

    def apply(self, spark: SparkSession, batch_id: int, compute: Callable[[], DataFrame],
              touched: list[int] | None = None, writer: str = "merge",
              metrics: Observation | None = None) -> None:
        """Replace the touched buckets by ``compute()`` (rows with ``__bucket``).

        The result is written once, partitioned by bucket, to the staging
        folder; its bucket folders are then moved into place by rename (a
        metadata operation, one per touched bucket, at most ``n``), and the
        commit marker is written last.  Redoing a half-finished move only
        moves the folders that are still in staging.  ``touched`` names the
        buckets being replaced: those that came out empty (every key deleted)
        are recorded in ``_EMPTY`` before anything moves, and their stored
        folders are removed.  ``metrics`` is an observation inside ``compute()``
        (a merge's counts); what it saw is kept beside the staged rows, so a
        commit finished after a crash reports it too.
        """
        if self.committed(spark, batch_id, writer):
            return
        self.check_layout(spark)
        staging = f"{self.root}/_staging/{writer}-{batch_id}"
        if not _exists(spark, f"{staging}/_SUCCESS"):
            obs = Observation(f"bucketed-{batch_id}")
            # REBALANCE by bucket: AQE gathers each bucket's rows into
            # advisory-sized partitions, splitting a huge (hot-key) bucket and
            # coalescing small ones -- a bounded number of files per bucket
            # instead of one per task and bucket
            out = compute().observe(obs, F.count(F.lit(1)).alias("rows")).hint("rebalance", BUCKET)
            out.write.mode("overwrite").partitionBy(BUCKET).parquet(staging)
            seen = {"numOutputRows": observed(obs).get("rows")}
            if metrics is not None:
                seen |= {METRIC_NAMES.get(k, k): v for k, v in observed(metrics).items()}
            _write_text(spark, f"{staging}/_FACTS", json.dumps({k: str(v) for k, v in seen.items() if v is not None}))
        fs, jvm = _fs(spark, self.root)
        path = jvm.org.apache.hadoop.fs.Path
        marker = path(f"{staging}/_EMPTY")
        if not fs.exists(marker):  # nothing has moved yet: the listing is complete
            present = {st.getPath().getName() for st in fs.listStatus(path(staging))}
            strange = {p for p in present if p.startswith(f"{BUCKET}=")} - {f"{BUCKET}={b}" for b in touched or []}
            if touched is not None and strange:
                raise RuntimeError(f"the result holds rows of buckets that the batch does not touch: {sorted(strange)}")
            empty = [b for b in touched or [] if f"{BUCKET}={b}" not in present]
            _write_text(spark, f"{staging}/_EMPTY", ",".join(map(str, empty)))
        empty = [int(x) for x in _read_text(spark, f"{staging}/_EMPTY").split(",") if x]
        fs.mkdirs(path(self.data))
        for b in empty:
            fs.delete(path(f"{self.data}/{BUCKET}={b}"), True)
        for st in fs.listStatus(path(staging)):
            name = st.getPath().getName()
            if not (st.isDirectory() and name.startswith(f"{BUCKET}=")):
                continue
            dest = path(f"{self.data}/{name}")
            if fs.exists(dest):
                fs.delete(dest, True)
            if not fs.rename(st.getPath(), dest):
                raise RuntimeError(f"could not move {st.getPath()} to {dest}")
        # the commit marker carries the batch's facts (O-07): one JSON line; a metric that nobody measured is absent
        measured = json.loads(_read_text(spark, f"{staging}/_FACTS")) if _exists(spark, f"{staging}/_FACTS") else {}
        facts = {"version": f"{writer}-{batch_id}", "operation": "WRITE" if writer == "load" else "MERGE",
                 "timestamp": datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f"),
                 "user_name": writer, "operation_metrics": {"numTouchedBuckets": str(len(touched or [])), **measured}}
        _write_text(spark, f"{self.root}/_commits/{writer}-{batch_id}", json.dumps(facts) + "\n")

    def current(self, spark: SparkSession) -> DataFrame:
        """The visible rows (tombstones, if the table keeps them, are hidden)."""
        df = self.read(spark).drop(BUCKET)
        if self.tombstone_col:
            df = df.filter(~F.coalesce(F.col(self.tombstone_col), F.lit(False))).drop(self.tombstone_col)
        return df

    def commit_log(self, spark: SparkSession) -> DataFrame:
        """One row per committed batch: version (writer and batch id),
        operation, timestamp, user_name (the writer), ``operation_metrics``
        (map) -- the shape ``audit.metrics_pivot`` reads."""
        schema = ("version string, operation string, timestamp string, user_name string, "
                  "operation_metrics map<string,string>")
        log = spark.read.schema(schema).json(f"{self.root}/_commits/*")
        return log.select("version", "operation", F.col("timestamp").cast("timestamp").alias("timestamp"),
                          "user_name", "operation_metrics")


def merge_in_place(spark: SparkSession, table: BucketedState, batch: DataFrame, merge: Callable[..., DataFrame],
                   batch_id: int, *, writer: str = "merge", **kwargs) -> None:
    """Apply a pure merge ``merge(target, batch, **kwargs) -> new state`` to a
    stored, key-bucketed table, reading and rewriting only the buckets of the
    batch's keys (SURVEY 4.4).  Keys never cross buckets, so the merge of the
    touched slice equals the touched slice of the full merge.  Replays of
    ``batch_id`` by the same ``writer`` are skipped; a crash is finished from
    the staged result.  A merge with an ``observation`` argument has its counts
    of inserted, updated, deleted and copied rows kept in the commit."""
    if table.committed(spark, batch_id, writer):
        return
    keyed = table.with_bucket(batch)
    touched = table.bucket_ids(keyed)
    metrics = None
    if "observation" in inspect.signature(merge).parameters and "observation" not in kwargs:
        metrics = kwargs["observation"] = Observation(f"merge-{writer}-{batch_id}")

    def compute() -> DataFrame:
        current = table.read(spark, touched).drop(BUCKET)
        return table.with_bucket(merge(current, keyed.drop(BUCKET), **kwargs))

    table.apply(spark, batch_id, compute, touched=touched, writer=writer, metrics=metrics)


def load(spark: SparkSession, table: BucketedState, df: DataFrame, batch_id: int = 0) -> None:
    """Load of a bucketed table (all buckets of ``df``), with batch ids of its own."""
    keyed = table.with_bucket(df)
    table.apply(spark, batch_id, lambda: keyed, touched=table.bucket_ids(keyed), writer="load")


def stream_writer(checkpoint: str) -> str:
    """The name under which a stream with this checkpoint commits."""
    import hashlib

    return "stream-" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
