"""Expectations, quarantine and file intake rules (Q-01 .. Q-07).

A rule is a named boolean expression that is *true* for a good row; a null
result counts as a failure.  Every action is a plain DataFrame transformation,
so it works unchanged on batch and streaming DataFrames:

* warn  -- rows kept, failures counted by an :class:`Observation` during the
  write that happens anyway (no second pass);
* drop  -- ``filter`` on all rules, failures counted the same way;
* fail  -- a ``filter`` whose predicate raises inside the plan on the first
  bad row; as a filter it cannot be pruned away the way an unused column can;
* quarantine -- one projection adds the names of the failed rules; good and
  bad rows are the two sides of that column.
"""

from __future__ import annotations

import re

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rules = Mapping[str, str | Column]
FAILED = "failed_rules"


def _pred(p: str | Column) -> Column:
    return F.expr(p) if isinstance(p, str) else p


def ok(p: str | Column) -> Column:
    """A rule's verdict with null treated as failure."""
    return F.coalesce(_pred(p), F.lit(False))


def all_ok(rules: Rules) -> Column:
    return reduce(lambda a, b: a & b, [ok(p) for p in rules.values()], F.lit(True))


def _metric_name(rule: str) -> str:
    return "failed:" + rule


def observe_rules(df: DataFrame, rules: Rules, observation: Observation | str) -> DataFrame:
    """Attach per-rule failure counts (plus the row count) to ``df``.

    On a batch DataFrame pass an :class:`Observation` and read ``.get`` after
    the action; on a stream pass a name and read ``observedMetrics`` from the
    query progress.
    """
    metrics = [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(~ok(p)).alias(_metric_name(name)) for name, p in rules.items()
    ]
    return df.observe(observation, *metrics)


def expect(df: DataFrame, rules: Rules, observation: Observation | str | None = None) -> DataFrame:
    """Q-01 (warn): keep every row, count failures."""
    return observe_rules(df, rules, observation) if observation is not None else df


def expect_or_drop(df: DataFrame, rules: Rules, observation: Observation | str | None = None) -> DataFrame:
    """Q-02: drop a row when any rule fails; failures are counted on the input."""
    if observation is not None:
        df = observe_rules(df, rules, observation)
    return df.filter(all_ok(rules))


def expect_or_fail(df: DataFrame, rules: Rules) -> DataFrame:
    """Q-03: fail the job on the first row that breaks a rule.

    The message names the broken rules.  Must stay a filter: a column holding
    ``raise_error`` would be pruned when nobody reads it.
    """
    failed = F.array_compact(F.array(*[F.when(~ok(p), F.lit(name)) for name, p in rules.items()]))
    guard = F.when(all_ok(rules), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("expectation failed: "), F.array_join(failed, ", "))).cast("boolean")
    )
    return df.filter(guard)


def tag_failures(df: DataFrame, rules: Rules, column: str = FAILED) -> DataFrame:
    """Q-04: add ``failed_rules``, the array of names of the rules a row breaks."""
    return df.withColumn(column, F.array_compact(F.array(*[F.when(~ok(p), F.lit(n)) for n, p in rules.items()])))


def quarantine(df: DataFrame, rules: Rules, column: str = FAILED) -> tuple[DataFrame, DataFrame]:
    """Q-04: ``(good, bad)``; bad rows carry the names of the rules they broke.

    Both sides come from the same tagged plan.  To pay for the input once,
    write ``tag_failures(df, rules)`` partitioned by ``size(failed_rules) > 0``
    or checkpoint it first.
    """
    tagged = tag_failures(df, rules, column)
    good = tagged.filter(F.size(column) == 0).drop(column)
    bad = tagged.filter(F.size(column) > 0)
    return good, bad


def failure_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """One aggregate pass: ``rule, n_rows, n_failed`` -- one row per rule."""
    names = list(rules)
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count_if(~ok(rules[n])).alias(f"f{i}") for i, n in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"f{i}").alias("n_failed")) for i, n in enumerate(names)])
    return agg.select(F.col("n_rows"), F.inline(pairs)).select("rule", "n_rows", "n_failed")


def not_null_rules(columns: Iterable[str] | T.StructType) -> dict[str, Column]:
    """Q-05: one rule per required column; from a name list or from the
    non-nullable fields of a schema (``NOT NULL`` DDL)."""
    if isinstance(columns, T.StructType):
        columns = [f.name for f in columns.fields if not f.nullable]
    return {f"{c} is not null": F.col(c).isNotNull() for c in columns}


# ---------------------------------------------------------------- file intake
ORIGIN_PREFIXES = ("EmployeeData", "PayrollData", "BranchData")


def valid_origin_name(name: Column, run_date: str | Column, *, prefixes: Sequence[str] = ORIGIN_PREFIXES,
                      compat: bool = False) -> Column:
    """Q-06: the file name follows the origin pattern and carries the run date.

    The name is one of ``prefixes``, ``_``, eight digits and ``.csv``.
    ``run_date`` is ``yyyyMMdd`` text or a date column.  The reference looks for
    the date in any ``_``-separated part; the date has no ``_``, so that is the
    same as the name containing it.  Strict (default) anchors the whole name,
    escapes the dot and wants the date exactly in the stamp.
    """
    stamp = F.lit(run_date) if isinstance(run_date, str) else F.date_format(run_date, "yyyyMMdd")
    origin = "|".join(re.escape(p) for p in prefixes)
    if compat:  # matched at the start only, the dot stands for any character
        return name.rlike(rf"^(?:{origin})_\d{{8}}.csv") & name.contains(stamp)
    return name.rlike(rf"^(?:{origin})_\d{{8}}\.csv$") & (F.regexp_extract(name, r"_(\d{8})\.csv$", 1) == stamp)


def route_files(files: DataFrame, name_col: str, run_date: str | Column, *, compat: bool = False,
                route_col: str = "route") -> DataFrame:
    """Q-07: ``ignored`` (not ``.csv``), ``rejected`` (bad name or date) or
    ``accepted`` per file or per row carrying its file name."""
    name = F.col(name_col)
    route = (
        F.when(name.isNull() | ~name.endswith(".csv"), "ignored")
        .when(F.coalesce(valid_origin_name(name, run_date, compat=compat), F.lit(False)), "accepted")
        .otherwise("rejected")
    )
    return files.withColumn(route_col, route)


def route_by(df: DataFrame, routes: Sequence[tuple[str, str | Column]], *, default: str | None = None,
             route_col: str = "route") -> DataFrame:
    """K-13: first matching route wins; one scan, one ``CASE`` column.  Each
    consumer then filters on ``route`` (a predicate Parquet can push down if
    the routed table is written partitioned by it)."""
    expr = None
    for name, pred in routes:
        cond = ok(pred)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    expr = expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)
    return df.withColumn(route_col, expr)


def has_rows(df: DataFrame) -> bool:
    """A-04 gate: is there anything to write?  Reads at most one row
    (``limit(1)``), never a full count; prefer an :class:`Observation` on the
    write itself when the count is wanted anyway."""
    return len(df.limit(1).take(1)) > 0


def write_quarantined(df: DataFrame, rules: Rules, path: str, *, fmt: str = "parquet",
                      column: str = FAILED) -> None:
    """Q-04 sink: one pass over the input writes good and bad rows together,
    partitioned by ``side`` (``side=good`` / ``side=bad`` folders); readers
    of either side prune to their folder."""
    tagged = tag_failures(df, rules, column).withColumn(
        "side", F.when(F.size(column) > 0, F.lit("bad")).otherwise(F.lit("good")))
    tagged.write.mode("overwrite").format(fmt).partitionBy("side").save(path)


# The same actions under the names of the declarative expectation calls.
expect_all = expect
expect_all_or_drop = expect_or_drop
expect_all_or_fail = expect_or_fail

