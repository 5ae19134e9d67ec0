"""Places and running totals over one global order, without a single-task window.

A window without a partition key sorts the whole table in one task, and a window
per key puts a hot key into one.  Here the rows are range-partitioned and sorted;
a row's place and totals are counted inside its partition and shifted by what all
partitions before it hold.  Only one row per partition comes to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

PART, POS = "__part", "__pos"


def sorted_parts(df: DataFrame, order: Sequence[str | Column], *, partitions: int | None = None,
                 name: str = "sorted") -> DataFrame:
    """``df`` cut into ranges of ``order`` and sorted, written under the shared
    checkpoint folder: ``__part`` numbers the ranges in order, ``__pos`` the rows
    of a range.  Rows that are equal in ``order`` stand in any order, but one
    that no later read changes."""
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    (df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
     .withColumn(PART, F.spark_partition_id())
     # the lower 33 bits of the id count the rows of the partition
     .withColumn(POS, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
     .write.mode("overwrite").parquet(path))
    schema = T.StructType([*df.schema.fields, T.StructField(PART, T.IntegerType()), T.StructField(POS, T.LongType())])
    return spark.read.schema(schema).parquet(path)


def running(df: DataFrame, order: Sequence[str | Column], *, at: str = "at",
            sums: Mapping[str, str] | None = None, xors: Mapping[str, str] | None = None,
            partitions: int | None = None, name: str = "running") -> DataFrame:
    """``df`` with the column ``at`` (a row's place in ``order``, from 0) and, for
    each ``{new: column}`` of ``sums`` and ``xors`` (integer columns), the total
    of the column over all rows before this one.

    Rows that are equal in ``order`` stand in any order, but one that no later
    read changes (:func:`sorted_parts`).  Nulls sort first unless ``order`` says otherwise; a null counts as 0 in
    totals.  An empty table gives an empty result.
    """
    sums, xors = dict(sums or {}), dict(xors or {})
    spark = df.sparkSession
    rows = sorted_parts(df, order, partitions=partitions, name=name)
    wanted = {new: F.coalesce(F.sum(c), F.lit(0)) for new, c in sums.items()}
    wanted |= {new: F.coalesce(F.bit_xor(F.col(c).cast("long")), F.lit(0).cast("long")) for new, c in xors.items()}
    held = {r[PART]: r for r in rows.groupBy(PART).agg(F.count(F.lit(1)).alias(POS), *[
        c.alias(new) for new, c in wanted.items()]).collect()}  # one row per partition
    bases, so_far = [], [0] * (1 + len(wanted))
    for part in sorted(held):
        bases.append((part, *so_far))
        row = held[part]
        so_far = [so_far[0] + row[POS], *[(b ^ row[new]) if new in xors else b + row[new]
                                           for b, new in zip(so_far[1:], wanted)]]
    if wanted:  # totals inside a partition: one task each, as evenly filled as the range partitions
        before = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
        inside = {new: F.coalesce((F.sum(sums[new]) if new in sums else F.bit_xor(F.col(xors[new]).cast("long"))).over(before),
                                  F.lit(0)) for new in wanted}
        rows = rows.select("*", *[c.alias(new) for new, c in inside.items()])
    base_cols = [f"__base_{k}" for k in range(len(so_far))]
    base = F.broadcast(spark.createDataFrame(bases, ", ".join([f"{PART} int", *[f"{c} long" for c in base_cols]])))
    out = rows.join(base, PART)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(base_cols[0]) + F.col(POS)).alias(at), *[
        (F.col(b).bitwiseXOR(F.col(new)) if new in xors else F.col(b) + F.col(new)).alias(new)
        for b, new in zip(base_cols[1:], wanted)])
