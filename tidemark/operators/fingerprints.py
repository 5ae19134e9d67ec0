"""Change detection in two phases (P-12): narrow fingerprints first, wide rows only
where they differ.

The stored table keeps a narrow companion: key and 128-bit fingerprint of the
compared columns.  A batch is fingerprinted on the fly and joined with the
companion, 16 bytes a row besides the key, instead of with the wide table.  Only
keys whose fingerprints differ are looked up in the table, with a semi join on
their keys, and compared null-safely, column by column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.compare import differs_prefixed
from tidemark.operators.diff import LABELS


def fingerprint128(columns: Sequence[str], types: dict[str, str]) -> list[Column]:
    """Two 64-bit hashes of the columns, cast to ``types`` (hashes depend on the
    type), with the places of the nulls, which a hash skips."""
    values = [F.col(f"`{c}`").cast(types[c]) for c in columns]
    nulls = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])
    return [F.xxhash64(F.lit(seed), nulls, *values).alias(f"__f{seed}") for seed in (1, 2)]


def fingerprints(table: DataFrame, keys: Sequence[str], compare: Sequence[str], types: dict[str, str] | None = None) -> DataFrame:
    """The narrow companion of ``table``: store it beside the table and keep it with every merge."""
    return table.select(*keys, *fingerprint128(compare, types or dict(table.dtypes)))


def changed_by_fingerprint(table: DataFrame, stored: DataFrame, batch: DataFrame, keys: Sequence[str],
                           compare: Sequence[str]) -> DataFrame:
    """The classes of :func:`tidemark.operators.diff.classify_changes` for
    ``batch`` against ``table`` (one row per key), through ``stored``, the
    table's :func:`fingerprints`.

    Equal fingerprints count as unchanged (two different rows share 128 bits
    with a chance of about 3e-39); different ones are verified on the wide rows.
    """
    keys, compare, types = list(keys), list(compare), dict(table.dtypes)
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    narrow = batch.select(*keys, *[c.alias(c_) for c, c_ in zip(fingerprint128(compare, types), ("__b1", "__b2"))])
    met = narrow.join(stored, keys, "left")
    same = (F.col("__b1") == F.col("__f1")) & (F.col("__b2") == F.col("__f2"))
    phase = (F.when(null_key, LABELS["null_key"]).when(F.col("__f1").isNull(), LABELS["new"])
             .when(same, LABELS["unchanged"]))
    first = met.select(*keys, phase.alias("change"))
    told = first.filter(F.col("change").isNotNull())
    doubtful = first.filter(F.col("change").isNull()).select(*keys).distinct()
    # wide rows of doubtful keys only, on both sides
    t = table.select(*keys, *[F.col(c).alias(f"t__{c}") for c in compare]).join(doubtful, keys, "left_semi")
    b = batch.select(*keys, *[F.col(c).cast(types[c]).alias(f"b__{c}") for c in compare]).join(doubtful, keys, "left_semi")
    # a batch may repeat a key: rows that were told apart above are not asked again
    verified = b.join(t, keys).select(
        *keys, F.when(differs_prefixed(compare, "t__", "b__"), LABELS["update"]).otherwise(LABELS["unchanged"]).alias("change"))
    told = told.join(doubtful, keys, "left_anti")
    missing = (stored.select(*keys).join(batch.select(*keys).distinct(), keys, "left_anti")
               .select(*keys, F.lit(LABELS["missing"]).alias("change")))
    return told.unionByName(verified).unionByName(missing)
