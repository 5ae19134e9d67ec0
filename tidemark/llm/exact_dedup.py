"""Operator 1, exact dedup: group by a 128-bit content hash, keep the smallest
stable id, compare bytes inside the groups.

Only DataFrame functions are used.  Texts are equal when they are identical
after every run of ASCII white space has become one space.

* The classes come from one aggregate whose key is (MD5, normalised text): rows
  are dealt by the key, equal keys are told apart by their bytes, so two texts
  that share a hash stay two classes.  Copies are combined before the shuffle:
  a group that holds a third of all rows sends one row per map task.
* The rows find their class by hashes only (MD5 with the SHA-256 that the result
  carries anyway), so no text is shuffled per copy and the adaptive skew join
  can split a hot group.

Edge cases: a null text is the empty text, and all empty texts are one group;
rows with a null id keep that id and stand after every other id; of repeated
rows with the smallest id of their group exactly one is ``kept``; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, numbered

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE_SPACE, " ")


def _decided(docs: DataFrame, id_col: str, text_col: str, hash_expr, rid: Column) -> DataFrame:
    """One row per input row: ``id``, ``rid`` (its number), ``keep_id``, ``n``,
    ``kept`` and ``sha``.

    ``hash_expr`` maps the normalised text to the grouping hash (MD5 unless
    given; tests pass a poor one to force collisions).
    """
    hash_expr = hash_expr or (lambda c: F.unhex(F.md5(c)))
    texts = (docs.select(rid.alias("rid"), F.col(f"`{id_col}`").alias("id"),
                         normalised(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("norm"))
             .withColumn("h", hash_expr(F.col("norm"))))
    rows = materialise(texts.select("id", "rid", "h", F.unhex(F.sha2("norm", 256)).alias("sha")), "exact-rows")
    classes = materialise(texts.groupBy("h", "norm").agg(F.min("id").alias("keep_id"), F.count("*").alias("n"))
                          .select("h", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "n"), "exact-classes")
    # of repeated rows with the smallest id the first one read stays
    first = (rows.join(classes.select("h", "sha", "keep_id"), ["h", "sha"])
             .filter(F.col("id").eqNullSafe(F.col("keep_id")))
             .groupBy("h", "sha", "keep_id").agg(F.min("rid").alias("first_rid")))
    told = first.join(classes.select("h", "sha", "n"), ["h", "sha"])
    return rows.join(told, ["h", "sha"]).select(
        "id", "rid", "keep_id", "n", (F.col("rid") == F.col("first_rid")).alias("kept"), "sha")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_expr=None) -> DataFrame:
    """One row per input row: ``id_col``, ``keep_id``, ``group_size``, ``kept``
    and ``text_sha256``."""
    return _decided(docs, id_col, text_col, hash_expr, F.monotonically_increasing_id()).select(
        F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"), "kept",
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_expr=None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows, rid = numbered(docs, "exact-numbered")
    dropped = _decided(rows, id_col, text_col, hash_expr, F.col(rid)).filter("not kept").select(F.col("rid").alias(rid))
    return rows.join(dropped, rid, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
