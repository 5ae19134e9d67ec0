"""Queries for the merge audit (O-07 with P-16, A-03, P-10, J-04, M-02) and profile (A-05)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.audit import MERGE_METRICS, merge_audit, metrics_pivot, profile
from tidemark.operators.merge import upsert_mapped
from tidemark.operators.sketches import report, sketch_profile
from tidemark.plans.fixtures import emp_batch, emp_target, table, with_employees
from tidemark.plans.registry import register
from tidemark.session import scratch_path
from tidemark.streaming.state import BucketedState, load, merge_in_place

NOTEBOOK = "audit_demo"
FIRST_DAYS_END = "2024-01-11"


def commits_from_events(spark, sf, until: str | None = None):
    """One commit per (event type, day): metrics map built from value bands;
    only purchases report deletes (the missing metric must come out as 0)."""
    ev = table(spark, sf, "events")
    if until is not None:
        ev = ev.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    et = F.col("event_type")
    g = ev.groupBy(et, F.to_date("ts").alias("day")).agg(
        F.max("ts").alias("timestamp"),
        F.count_if(F.col("value") < 100).alias("ins"),
        F.count_if((F.col("value") >= 100) & (F.col("value") < 200)).alias("upd"),
        F.count_if(F.col("value") >= 200).alias("del"),
    )
    op = F.when(et == "purchase", "MERGE").when(et == "view", "WRITE").otherwise(F.upper(et))
    metrics = F.when(
        et == "purchase",
        F.create_map(F.lit("numTargetRowsInserted"), F.col("ins").cast("string"),
                     F.lit("numTargetRowsUpdated"), F.col("upd").cast("string"),
                     F.lit("numTargetRowsDeleted"), F.col("del").cast("string")),
    ).otherwise(F.create_map(F.lit("numTargetRowsInserted"), F.col("ins").cast("string"),
                             F.lit("numTargetRowsUpdated"), F.col("upd").cast("string")))
    return g.select(
        F.concat_ws("@", et, F.date_format("day", "yyyy-MM-dd")).alias("version"),
        op.alias("operation"), "timestamp",
        F.concat(F.lit("user_"), (F.dayofmonth("day") % 3).cast("string")).alias("user_name"),
        metrics.alias("operation_metrics"),
    )


COMMITS_SQL = """commits as (
  select event_type || '@' || strftime(cast(ts as date), '%Y-%m-%d') as version,
    case when event_type = 'purchase' then 'MERGE' when event_type = 'view' then 'WRITE' else upper(event_type) end
      as operation,
    max(ts) as timestamp, 'user_' || cast(day(cast(ts as date)) % 3 as varchar) as user_name,
    count(*) filter (where value < 100) as ins,
    count(*) filter (where value >= 100 and value < 200) as upd,
    case when event_type = 'purchase' then count(*) filter (where value >= 200) else 0 end as del
  from events {where} group by event_type, cast(ts as date))"""


def _pivot_sql(where: str = "") -> str:
    return "with " + COMMITS_SQL.format(where=where) + """,
pivoted as (select version, ins as numTargetRowsInserted, upd as numTargetRowsUpdated, del as numTargetRowsDeleted,
  operation, timestamp, user_name from commits where operation in ('MERGE', 'WRITE'))"""


@register("metrics_pivot", _pivot_sql() + "\nselect * from pivoted")
def q_metrics_pivot(spark, sf):
    return metrics_pivot(commits_from_events(spark, sf))


@register("merge_audit", _pivot_sql() + f""",
latest as (select * from (select *, row_number() over (partition by operation order by timestamp desc, version desc) rn
  from pivoted) x where rn = 1)
select operation, timestamp as update_time, user_name, '{NOTEBOOK}' as notebook_name,
  numTargetRowsInserted, numTargetRowsUpdated, numTargetRowsDeleted from latest""")
def q_merge_audit(spark, sf):
    """First audit from the commits of the first ten days, then the full log
    is merged in: per operation the latest commit wins."""
    first = merge_audit(_empty_audit(spark), metrics_pivot(commits_from_events(spark, sf, FIRST_DAYS_END)),
                        notebook_name="first_run")
    return merge_audit(first, metrics_pivot(commits_from_events(spark, sf)), notebook_name=NOTEBOOK)


_WRITERS = ((0, "hr"), (1, "payroll"), (2, "hr"))


def _commit_sql(k: int, writer: str) -> str:
    """Counts of one merge from the states before and after it; merges of other thirds touch other keys."""
    b = f"(select * from emp_batch where id % 3 = {k})"
    t = "(select * from emp_target where status = 'Active')"
    return f"""select '{writer}-{k}' as version, 'MERGE' as operation, '{writer}' as user_name,
  (select count(*) from {b} b where not exists (select 1 from {t} t where t.id = b.id)) as numTargetRowsInserted,
  (select count(*) from {b} b join {t} t on t.id = b.id where not coalesce(b.country = 'MOVED', false)) as numTargetRowsUpdated,
  (select count(*) from {b} b join {t} t on t.id = b.id where b.country = 'MOVED') as numTargetRowsDeleted"""


@register("audit_of_commits", with_employees("\nunion all\n".join([
    "select 'load-0' as version, 'WRITE' as operation, 'load' as user_name, cast(null as bigint) as numTargetRowsInserted, "
    "cast(null as bigint) as numTargetRowsUpdated, cast(null as bigint) as numTargetRowsDeleted",
    *[_commit_sql(k, w) for k, w in _WRITERS]])))
def q_audit_of_commits(spark, sf):
    """O-07 from real merges: a load and three merges by two writers into a
    stored table; the counts are those observed while the merges were written."""
    target = emp_target(spark, sf).filter(F.col("status") == "Active").drop("eskey", "status", "start_date", "end_date",
                                                                            "created_date")
    stored = BucketedState(scratch_path(spark, "audited"), ["id"], target.schema, n_buckets=16)
    load(spark, stored, target)
    batch = emp_batch(spark, sf)
    for k, writer in _WRITERS:
        merge_in_place(spark, stored, batch.filter(F.col("id") % 3 == k), upsert_mapped, k, writer=writer, keys=["id"],
                       update_set={c: f"s.{c}" for c in target.columns if c != "id"},
                       insert_values={c: f"s.{c}" for c in target.columns}, delete_condition="s.country = 'MOVED'")
    return metrics_pivot(stored.commit_log(spark), missing=None).drop("timestamp")


def _empty_audit(spark):
    cols = ", ".join(f"{m} bigint" for m in MERGE_METRICS)
    return spark.createDataFrame([], f"operation string, update_time timestamp_ntz, user_name string, "
                                     f"notebook_name string, {cols}")


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_NUMERIC_COLS = set(LINEITEM_COLS[:8])
_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
          "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
          "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}


def _profile_sql() -> str:
    parts = []
    for c in LINEITEM_COLS:
        num = c in _NUMERIC_COLS
        mean = f"round(avg({c}), 4)" if num else "cast(null as double)"
        sd = f"round(stddev_samp({c}), 4)" if num else "cast(null as double)"
        parts.append(
            f"select '{c}' as column_name, '{_TYPES[c]}' as data_type, count(*) as n_rows, "
            f"count(*) filter (where {c} is null) as n_nulls, cast(min({c}) as varchar) as min_value, "
            f"cast(max({c}) as varchar) as max_value, {mean} as mean, {sd} as stddev from lineitem")
    return "\nunion all\n".join(parts)


@register("profile_table", _profile_sql())
def q_profile_table(spark, sf):
    """Exact statistics only (the approximate ones have no SQL twin)."""
    return profile(table(spark, sf, "lineitem").select(*LINEITEM_COLS), approx=False, rounding=4)


@register("profile_approx")
def q_profile_approx(spark, sf):
    return profile(table(spark, sf, "lineitem"), approx=True)


@register("profile_merged", _profile_sql())
def q_profile_merged(spark, sf):
    """A-05 by stored sketches of three loads, merged without reading them again
    (the approximate columns, which SQL can't state, are left to the tests)."""
    lines = table(spark, sf, "lineitem").select(*LINEITEM_COLS)
    stored = scratch_path(spark, "sketches")
    for k in range(3):
        sketch_profile(lines.filter(F.col("l_orderkey") % 3 == k)).write.parquet(f"{stored}/load={k}")
    return report(spark.read.parquet(stored).drop("load"), rounding=4).drop("approx_distinct", "approx_quantiles")
