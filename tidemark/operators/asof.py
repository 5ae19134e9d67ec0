"""Point-in-time reads for a column of instants (M-10): which version of its key was
valid at each row's own instant.

A range condition between versions and instants would be a join of all pairs of a
key.  Here versions and instants are one sorted sequence: a row takes the last
version before it.  The sequence is cut into ranges of (key, time), so a key with a
third of all rows is spread over tasks; what a range must know from the ones before
it is the last version of the one key that began there, at most a few rows a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.order import PART, POS, sorted_parts


def as_of_each(history: DataFrame, rows: DataFrame, keys: Sequence[str], at: str, *, start_col: str = "__START_AT",
               end_col: str | None = "__END_AT", columns: Sequence[str] | None = None,
               partitions: int | None = None) -> DataFrame:
    """Every row of ``rows`` with the columns of the version of its key that was
    valid at the instant ``at``: ``start <= at and (end is null or at < end)``;
    nulls where there was none, or the key or the instant is null.

    ``columns`` (default: all but the keys) are the version's columns to add;
    their names must differ from those of ``rows``.  Without ``end_col`` a
    version is valid until the next one starts.  Of versions with one start the
    one that ends last counts.
    """
    keys = list(keys)
    columns = list(columns) if columns is not None else [c for c in history.columns if c not in keys]
    clash = set(columns) & set(rows.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}; rename or choose columns")
    time = history.schema[start_col].dataType
    ends = F.col(end_col) if end_col else F.lit(None).cast(time)
    version = F.struct(F.struct(*[F.col(c) for c in columns]).alias("v"), ends.alias("e"))
    row = F.struct(*[F.col(c) for c in rows.columns])
    complete = " and ".join(f"`{k}` is not null" for k in keys)
    versions = history.filter(complete).select(
        *keys, F.col(start_col).alias("__t"), F.lit(0).alias("__kind"), ends.alias("__e"), version.alias("__version"),
        F.lit(None).cast(rows.select(row).schema[0].dataType).alias("__row"))
    asks = rows.select(
        *[F.col(k).cast(history.schema[k].dataType) for k in keys], F.col(at).cast(time).alias("__t"),
        F.lit(1).alias("__kind"), F.lit(None).cast(time).alias("__e"),
        F.lit(None).cast(versions.schema["__version"].dataType).alias("__version"), row.alias("__row"))
    order = [*[F.col(k).asc_nulls_first() for k in keys], F.col("__t").asc_nulls_first(), "__kind",
             F.col("__e").asc_nulls_last()]
    both = sorted_parts(versions.unionByName(asks), order, partitions=partitions, name="as-of")

    key = F.struct(*keys)
    # what may go on from one range to the next: the first and the last key of each, two rows a range at most
    edge = both.groupBy(PART).agg(F.min_by(key, POS).alias("a"), F.max_by(key, POS).alias("b"))
    edge = edge.select(F.explode(F.array("a", "b")).alias("__key")).distinct()
    last = (both.withColumn("__key", key).join(F.broadcast(edge), "__key", "left_semi")
            .groupBy("__key", PART).agg(F.max_by("__version", F.when(F.col("__kind") == 0, F.col(POS))).alias("__last")))
    before = Window.partitionBy("__key").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = (last.select("__key", F.col(PART).alias("__to"), F.last("__last", ignorenulls=True).over(before).alias("__carried"))
               .filter(F.col("__carried").isNotNull()))

    inside = Window.partitionBy(PART, *keys).orderBy(POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (both.withColumn("__found", F.last("__version", ignorenulls=True).over(inside)).filter(F.col("__kind") == 1)
             .withColumn("__key", key))
    found = found.join(F.broadcast(carried.withColumnRenamed("__key", "__of")),
                       (F.col("__of") == F.col("__key")) & (F.col("__to") == F.col(PART)), "left")
    hit = F.coalesce("__found", "__carried")
    valid = hit.isNotNull() & F.col("__t").isNotNull() & F.coalesce(F.col("__t") < hit["e"], F.lit(True))
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    return found.select("__row", F.when(valid, hit["v"]).alias("__hit")).select(
        "__row.*", *[F.col("__hit")[c].alias(c) for c in columns])
