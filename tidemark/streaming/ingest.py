"""Incremental file ingest and stream sinks (S-02, S-05, T-01, T-02, K-09, Q-07 stream side).

Each file is processed once: the file source records what it has read in the
checkpoint's offset and commit logs, so a restart on the same checkpoint adds
nothing.  ``trigger(availableNow=True)`` processes everything that has landed
in bounded micro-batches and stops -- the batch-job way to run a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.files import csv_options, csv_write_options, without_line_breaks


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    fmt: str = "csv",
    max_files_per_trigger: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
    ignore_missing_files: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """S-02: a file stream with an explicit schema.

    ``clean_source="archive"`` with ``archive_dir`` moves files away once
    their batch is committed (the reference's archive step, Q-07); Spark
    archives lazily, so the newest files stay until a later batch.
    """
    r = spark.readStream.format(fmt).schema(schema).option("ignoreMissingFiles", str(ignore_missing_files).lower())
    if fmt == "csv":
        r = r.options(**csv_options())
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    if options:
        r = r.options(**options)
    return r.load(path)


def run_available(df: DataFrame, checkpoint: str, *, sink: Callable | None = None, fmt: str = "parquet",
                  path: str | None = None, query_name: str | None = None, output_mode: str = "append",
                  options: Mapping[str, str] | None = None) -> StreamingQuery:
    """Run a stream over everything available now and wait for it to finish.

    ``sink`` is a ``foreachBatch`` function; otherwise rows are appended to
    ``path`` in ``fmt`` (K-09 / T-02).
    """
    if sink is None and fmt == "csv":
        df = without_line_breaks(df)
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    if sink is not None:
        w = w.foreachBatch(sink).outputMode(output_mode)
    else:
        w = w.format(fmt).outputMode(output_mode).option("path", path)
        if fmt == "csv":
            w = w.options(**csv_write_options())
    if options:
        w = w.options(**options)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def append_stream(df: DataFrame, path: str, checkpoint: str, *, fmt: str = "parquet") -> StreamingQuery:
    """K-09 / T-02: append a stream to files, exactly once per input file."""
    return run_available(df, checkpoint, fmt=fmt, path=path)
