"""Sinks and publication (K-04, K-06 .. K-08, K-13 helpers).

* ``append_aligned`` replaces positional ``insertInto``: columns are matched by
  *name* and cast explicitly to the table's types.
* ``export_single_csv`` writes one named CSV file.  One file means one writing
  task, so it refuses inputs above a row cap (checked with a bounded
  ``limit(cap + 1).count()``, never a full count); larger extracts go to
  ``export_parts``: bounded, ordered and named files, written by many tasks.
* ``publish_version`` writes a new table version to its own folder and only
  then moves the ``_CURRENT`` pointer, so readers never see a half-written
  table and the input of a merge is never overwritten while it is read.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.order import running
from tidemark.session import path_exists
from tidemark.sources.files import csv_write_options, without_line_breaks

SINGLE_FILE_ROW_CAP = 1_000_000


def align_to(df: DataFrame, target_schema_df: DataFrame, *, strict: bool = True) -> DataFrame:
    """Select the target's columns by name from ``df``, cast to the target's
    types; missing columns become null, extra ones are dropped.  ``strict``
    uses ``cast`` (bad text fails the job under ANSI); otherwise ``try_cast``."""
    conv = F.col
    out = []
    have = {c.lower(): c for c in df.columns}
    for name, dtype in target_schema_df.dtypes:
        src = have.get(name.lower())
        if src is None:
            out.append(F.lit(None).cast(dtype).alias(name))
        elif strict:
            out.append(conv(src).cast(dtype).alias(name))
        else:
            out.append(conv(src).try_cast(dtype).alias(name))
    return df.select(*out)


def append_aligned(target: DataFrame, incoming: DataFrame, *, strict: bool = True) -> DataFrame:
    """K-04: the table after appending ``incoming`` aligned by name."""
    return target.unionByName(align_to(incoming, target, strict=strict))


def _jvm_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def export_single_csv(df: DataFrame, folder: str, file_name: str, *, row_cap: int = SINGLE_FILE_ROW_CAP,
                      header: bool = True) -> str:
    """K-06 / K-07: one CSV file named ``file_name`` in ``folder``.

    Writes to a temporary sibling folder with one partition, then renames the
    single part file through the Hadoop FileSystem API and removes the rest.
    """
    spark = df.sparkSession
    if df.limit(row_cap + 1).count() > row_cap:
        raise ValueError(f"more than {row_cap} rows: a single-file export would run in one task; use export_parts")
    tmp = f"{folder.rstrip('/')}/_tmp_export_{uuid.uuid4().hex}"
    without_line_breaks(df).coalesce(1).write.mode("overwrite").options(**csv_write_options(header)).csv(tmp)
    fs, tmp_path, jvm = _jvm_fs(spark, tmp)
    parts = [s.getPath() for s in fs.listStatus(tmp_path) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file, found {len(parts)}")
    dest = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{file_name}")
    if fs.exists(dest):
        fs.delete(dest, False)
    if not fs.rename(parts[0], dest):
        raise RuntimeError(f"could not move export to {dest}")
    fs.delete(tmp_path, True)
    return dest.toString()


def export_parts(df: DataFrame, folder: str, order: Sequence[str | Column], rows_per_part: int, *, name: str = "part",
                 header: bool = True, place_col: str | None = None) -> list[str]:
    """K-06 / K-07 without a cap: the rows in ``order`` as CSV files
    ``<name>_000000.csv``, ``<name>_000001.csv``, ... of ``rows_per_part`` rows
    each (the last may be shorter), each file sorted, all sorted by their names.

    The input is computed once: range partitions and two-level counts give each
    row its part and its place in it (:func:`tidemark.operators.order.running`),
    then every part is written by one task, many at a time.  Rows equal in
    ``order`` get any places.  ``place_col`` also writes the place (from 0).
    Parts become visible by rename, and ``_PARTS`` (their names and the number
    of rows, written last) tells that all are there; files of an earlier export
    under the same name are replaced.
    """
    spark = df.sparkSession
    folder = folder.rstrip("/")
    tmp = f"{folder}/_tmp_export_{uuid.uuid4().hex}"
    at, part = F.col("__at"), (F.col("__at") / F.lit(rows_per_part)).cast("long")
    place = [F.pmod(at, F.lit(rows_per_part).cast("long")).alias(place_col)] if place_col else []
    placed = running(without_line_breaks(df), order, at="__at", name="export")
    n = placed.agg(F.max("__at")).first()[0]
    n_rows = 0 if n is None else n + 1
    n_parts = -(-n_rows // rows_per_part)
    if n_parts:
        (placed.withColumn("__part", part).repartition(n_parts, "__part").sortWithinPartitions("__part", "__at")
         .select(*[F.col(f"`{c}`") for c in df.columns], *place, "__part")
         .write.mode("overwrite").options(**csv_write_options(header)).partitionBy("__part").csv(tmp))
    fs, base, jvm = _jvm_fs(spark, folder)
    path = jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(base)
    listing = path(f"{folder}/_PARTS")
    fs.delete(listing, False)
    for st in fs.listStatus(base):
        old = st.getPath().getName()
        if re.fullmatch(re.escape(name) + r"_\d{6,}\.csv", old):
            fs.delete(st.getPath(), False)
    done = []
    for k in range(n_parts):
        files = [s.getPath() for s in fs.listStatus(path(f"{tmp}/__part={k}")) if s.getPath().getName().startswith("part-")]
        if len(files) != 1:
            raise RuntimeError(f"expected one file of part {k}, found {len(files)}")
        done.append(f"{name}_{k:06d}.csv")
        if not fs.rename(files[0], path(f"{folder}/{done[-1]}")):
            raise RuntimeError(f"could not move part {k} to {folder}")
    fs.delete(path(tmp), True)
    out = fs.create(listing, True)
    out.write(bytearray(json.dumps({"rows": n_rows, "parts": done}).encode()))
    out.close()
    return [f"{folder}/{f}" for f in done]


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], *, mode: str = "append",
               num_partitions: int | None = None) -> None:
    """K-08: executors write in parallel; credentials come from ``properties``
    (never from code).  ``num_partitions`` bounds concurrent connections."""
    if num_partitions is not None:
        df = df.coalesce(num_partitions)
    df.write.jdbc(url, table, mode=mode, properties=dict(properties))


def publish_version(df: DataFrame, table_root: str, version: int | str) -> str:
    """Write ``df`` as version ``version`` under ``table_root`` and point
    ``_CURRENT`` at it afterwards.  Returns the version folder."""
    spark = df.sparkSession
    folder = f"{table_root.rstrip('/')}/v={version}"
    df.write.mode("overwrite").parquet(folder)
    pointer = f"{table_root.rstrip('/')}/_CURRENT"
    spark.createDataFrame([(str(version),)], "v string").coalesce(1).write.mode("overwrite").text(pointer)
    return folder


def current_version(spark: SparkSession, table_root: str) -> str | None:
    pointer = f"{table_root.rstrip('/')}/_CURRENT"
    if not path_exists(spark, pointer):
        return None  # nothing published yet
    rows = spark.read.text(pointer).take(1)
    return rows[0][0] if rows else None


def read_current(spark: SparkSession, table_root: str) -> DataFrame | None:
    v = current_version(spark, table_root)
    return spark.read.parquet(f"{table_root.rstrip('/')}/v={v}") if v is not None else None


def empty_like(spark: SparkSession, schema) -> DataFrame:
    """K-12: the empty target a CDC flow starts from (state before batch 0)."""
    return spark.createDataFrame([], schema)
