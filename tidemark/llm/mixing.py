"""Operator 11, mixing sources to target weights.

Words are summed per source, targets are shared out by weight, and the ratio of
target to size is the source's repetition rate.  A document is taken
``floor(rate)`` times, and once more when a number drawn from the hash of its id
lies below the fraction of the rate.

* Targets.  ``share`` times all words are dealt by weight; no source takes more
  than ``most`` times its words, and what it can't take is dealt again.  That is
  ``min(most * size, level * weight)`` with one level for all sources.  In the
  order of ``most * size / weight`` the full sources come first, so the level
  follows from running totals over the sources, which are spread over tasks as
  anything else: there may be millions of sources.
* Rows are joined to their source's rate.  The sizes per source are combined
  before the shuffle, and the adaptive join splits a source that holds a third
  of all rows (or broadcasts the sources where the planner knows them to be few).
* The draw is the first 52 bits of the MD5 of seed and id, so reruns agree and
  no order of rows matters.

Edge cases: a null or empty text has size 0 and is taken 0 times in words; rows
with a null source are a source of their own, the last one; a source without
words has target and rate 0; rows with a null id draw by their text; rows that
repeat an id (or a text, without id) share a draw; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise
from tidemark.operators.order import running

WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The number of words of a text, null for a null text."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def draw_of(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the MD5 of seed and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def targets(sources: DataFrame, share: float, most: float, weights: Sequence[int]) -> DataFrame:
    """``source``, ``size`` and ``target`` for a table of distinct sources with
    ``size`` (long); weights repeat over the sources in code point order, null last."""
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    weighted = materialise(running(sources, [F.col("source").asc_nulls_last()], name="llm-mix-sources")
                           .select("source", "size", weight.cast("long").alias("weight"))
                           .withColumn("cap", F.col("size") * F.lit(float(most))), "mix-weights")
    all_size, all_weight = weighted.agg(F.sum("size"), F.sum("weight")).first()
    if all_size is None:
        return sources.select("source", "size", F.lit(0.0).alias("target"))
    total = share * all_size
    filling = running(weighted, [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()],
                      sums={"size_before": "size", "weight_before": "weight"}, name="llm-mix-filling")
    # at the level where this source is full, the ones before it are full and the others take by weight
    dealt = (F.col("size_before") * F.lit(float(most))
             + F.col("cap") / F.col("weight") * (F.lit(all_weight) - F.col("weight_before")))
    filling = materialise(filling.withColumn("full", dealt <= F.lit(total)), "mix-full")
    full_size, full_weight = filling.filter("full").agg(F.coalesce(F.sum("size"), F.lit(0)),
                                                        F.coalesce(F.sum("weight"), F.lit(0))).first()
    level = (F.col("weight") * F.lit(total - most * full_size)) / F.lit(float(max(all_weight - full_weight, 1)))
    return filling.select("source", "size", F.when(F.col("full"), F.col("cap")).otherwise(
        F.least("cap", level)).alias("target"))


def source_rates(sized: DataFrame, share: float, most: float, weights: Sequence[int]) -> DataFrame:
    """``of`` (the source), ``source_size``, ``target`` and ``rate`` from the
    columns ``source`` and ``size``."""
    per_source = sized.groupBy("source").agg(F.sum("size").alias("size"))
    return materialise(targets(per_source, share, most, weights).select(
        F.col("source").alias("of"), F.col("size").alias("source_size"), "target",
        F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0).alias("rate")), "mix-rates")


def copies_of(draw: Column, rate: Column) -> Column:
    """How often a document is taken."""
    return F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")


def _sized(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`")
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
                       F.coalesce(words_of(text), F.lit(0).cast("long")).alias("size"),
                       draw_of(key, seed).alias("draw"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: Sequence[int] = (3, 1, 2), seed: int = 11,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: ``id_col``, ``size``, ``source_size``, ``target`` and
    ``rate`` of its source, ``copies`` (how often the mix takes it) and ``taken``
    (the words of the copies)."""
    sized = materialise(_sized(docs, seed, id_col, text_col, source_col).drop("row"), "mix-sizes")
    rates = source_rates(sized, share, most, weights)
    return (sized.join(rates, F.col("source").eqNullSafe(F.col("of")))
            .select(F.col("id").alias(id_col), "size", "source_size", "target", "rate",
                    copies_of(F.col("draw"), F.col("rate")).alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def emit(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: Sequence[int] = (3, 1, 2), seed: int = 11,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs`` with all its columns, as often as
    :func:`mix` says."""
    sized = _sized(docs, seed, id_col, text_col, source_col)
    rates = source_rates(sized.select("source", "size"), share, most, weights)
    copies = F.array_repeat(F.lit(True), copies_of(F.col("draw"), F.col("rate")).cast("int"))
    return (sized.join(rates, F.col("source").eqNullSafe(F.col("of")))
            .select("row", F.explode(copies)).select("row.*"))
