"""Helpers shared by the operators: table access and cutting lineage on shared storage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    The written files cut the lineage: a lost executor is recovered by reading
    them again, and what is used several times is computed once.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows with a number each, and the number's column (a name that no other
    column has).  Numbers are given once and written, so whatever reads the table
    again, on however many cores, sees the same ones."""
    column = "__rid"
    while column in map(str.lower, docs.columns):
        column += "_"
    return materialise(docs.withColumn(column, F.monotonically_increasing_id()), name), column


def kept_beside(docs: DataFrame, *names: str) -> list[str]:
    """The columns of ``docs`` but those that a new one of ``names`` replaces."""
    new = {n.lower() for n in names}
    return [c for c in docs.columns if c.lower() not in new]


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under names of its own (``id``,
    ``text``); every other column, whatever its name, is left behind.  A null
    text is the empty text."""
    return docs.select(F.col(f"`{id_col}`").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows of about ``max_bytes`` each (at
    least one row), so that a task's memory follows the longest text and not
    the batch."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        per_row = max(1, batch.nbytes // batch.num_rows)
        if batch.nbytes <= max_bytes:
            yield batch
            continue
        step = max(1, max_bytes // per_row)
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


class Known(dict):
    """Values by key, worked out when first asked for; emptied when full."""

    def __init__(self, work_out: Callable, limit: int):
        super().__init__()
        self.work_out, self.limit = work_out, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.work_out(key)
        return value
