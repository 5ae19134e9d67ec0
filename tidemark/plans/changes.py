"""Queries for change detection, merges and history (C-*, M-*, J-*, P-11, P-12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import mask_email
from tidemark.operators import diff, fingerprints, history, merge
from tidemark.operators.joins import attach_columns, demote_matched
from tidemark.plans.fixtures import RUN_TS, emp_batch, emp_target, employees, table, with_employees
from tidemark.plans.registry import register
from tidemark.session import scratch_path
from tidemark.streaming.state import BucketedState, load, merge_in_place

VALUES = ["name", "dob", "gender", "country", "email"]
RUN_DAY = RUN_TS[:10]


def _is_distinct(cols, left, right):
    return " or ".join(f"{left}.{c} is distinct from {right}.{c}" for c in cols)


# DuckDB form of the e-mail mask (no look-behind; equal on all cases of P-11).
def mask_sql(e: str) -> str:
    return (
        f"case when regexp_matches({e}, '^.{{2,}}@') "
        f"then regexp_replace({e}, '^(..)(.*)@', "
        f"case when regexp_matches({e}, '^...+@') then '\\1xxxxxx@' else '\\1xxx@' end) "
        f"else {e} end"
    )


# ------------------------------------------------------------------ C-01 / C-02
@register(
    "classify_changes",
    with_employees(f"""
select coalesce(s.id, t.id) as id,
  case when t.id is null then 'new' when s.id is null then 'missing'
       when {_is_distinct(VALUES, 't', 's')} then 'update' else 'unchanged' end as change
from (select * from emp_target where status = 'Active') t
full outer join emp_batch s on t.id = s.id"""),
)
def q_classify_changes(spark, sf):
    t = emp_target(spark, sf).filter(F.col("status") == "Active")
    return diff.classify_changes(t, emp_batch(spark, sf), ["id"], VALUES)


@register(
    "change_counts",
    with_employees(f"""
select change, count(*) as n from (
select case when t.id is null then 'new' when s.id is null then 'missing'
       when {_is_distinct(VALUES, 't', 's')} then 'update' else 'unchanged' end as change
from (select * from emp_target where status = 'Active') t
full outer join emp_batch s on t.id = s.id) x group by change"""),
)
def q_change_counts(spark, sf):
    t = emp_target(spark, sf).filter(F.col("status") == "Active")
    c = diff.classify_changes(t, emp_batch(spark, sf), ["id"], VALUES)
    return c.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


@register(
    "classify_compat",
    with_employees(f"""
select coalesce(s.id, t.id) as id,
  case when t.id is null then 'New' when s.id is null then 'Exist'
       when {_is_distinct(VALUES + ['file_name'], 't', 's')} then 'Update' else 'Exist' end as change
from (select * from emp_target where status = 'Active') t
full outer join emp_batch s on t.id = s.id"""),
)
def q_classify_compat(spark, sf):
    t = emp_target(spark, sf).filter(F.col("status") == "Active")
    return diff.classify_changes(t, emp_batch(spark, sf), ["id"], VALUES + ["file_name"], labels=diff.COMPAT_LABELS)


@register(
    "classify_by_presence",
    with_employees("""
select coalesce(s.id, t.id) as id,
  case when s.id is null then 'NA' when t.id is null then 'New' else 'Update' end as change
from (select distinct id from emp_target) t full outer join emp_batch s on t.id = s.id"""),
)
def q_classify_by_presence(spark, sf):
    return diff.classify_by_presence(emp_target(spark, sf), emp_batch(spark, sf), ["id"], compat=True)


@register(
    "row_diff",
    with_employees(f"""
select * from (
select t.id, concat_ws(',', {', '.join(f"case when t.{c} is distinct from s.{c} then '{c}' end" for c in VALUES)}) as changed
from (select * from emp_target where status = 'Active') t join emp_batch s on t.id = s.id) x
where changed <> ''"""),
)
def q_row_diff(spark, sf):
    t = emp_target(spark, sf).filter(F.col("status") == "Active")
    c = diff.classify_changes(t, emp_batch(spark, sf), ["id"], VALUES, with_changed_columns=True)
    return c.filter(F.col("change") == "update").select("id", F.concat_ws(",", "changed_columns").alias("changed"))


# ------------------------------------------------------------------ M-05 (flagship)
TWO_VERSION_CTES = f"""
tv_a as (select * from emp_target where status = 'Active'),
tv_i as (select * from emp_target where status = 'InActive'),
tv_u as (select b.id from emp_batch b join tv_a a on a.id = b.id left join tv_i i on i.id = b.id
         where i.id is not null or {_is_distinct(VALUES + ['file_name'], 'a', 'b')}),
two_version as (
select b.id, b.name, b.dob, b.gender, b.country, b.email, 0 as eskey, 'Active' as status,
  cast('{RUN_TS}' as timestamp) as start_date,
  cast('9999-12-31 00:00:00' as timestamp) as end_date, b.file_name,
  cast('{RUN_TS}' as timestamp) as created_date
from emp_batch b where not exists (select 1 from emp_target t where t.id = b.id)
union all
select b.id, b.name, b.dob, b.gender, b.country, b.email, 0, 'Active', a.start_date, a.end_date,
  b.file_name, cast('{RUN_TS}' as timestamp)
from emp_batch b join tv_a a on a.id = b.id where b.id in (select id from tv_u)
union all
select a.id, a.name, a.dob, a.gender, a.country, a.email, 1, 'InActive',
  coalesce(i.start_date, a.start_date),
  coalesce(i.end_date, cast('{RUN_TS}' as timestamp)), a.file_name,
  cast('{RUN_TS}' as timestamp)
from tv_a a left join tv_i i on i.id = a.id where a.id in (select id from tv_u)
union all
select id, name, dob, gender, country, email, eskey, status, start_date, end_date, file_name, created_date
from emp_target where id not in (select id from tv_u))"""


def two_version_state(spark, sf):
    return history.two_version_merge(emp_target(spark, sf), emp_batch(spark, sf), run_ts=RUN_TS, compat=True)


@register("two_version_merge", with_employees(f"with {TWO_VERSION_CTES}\nselect * from two_version"))
def q_two_version_merge(spark, sf):
    return two_version_state(spark, sf)


TWO_VERSION_FIXED_CTES = f"""
fx_a as (select * from emp_target where status = 'Active'),
fx_u as (select b.* from emp_batch b join fx_a a on a.id = b.id where {_is_distinct(VALUES, 'a', 'b')}),
two_version_fixed as (
select b.id, b.name, b.dob, b.gender, b.country, b.email, 0 as eskey, 'Active' as status,
  cast('{RUN_TS}' as timestamp) as start_date, cast('9999-12-31 00:00:00' as timestamp) as end_date,
  b.file_name, cast('{RUN_TS}' as timestamp) as created_date
from emp_batch b where not exists (select 1 from emp_target t where t.id = b.id)
union all
select u.id, u.name, u.dob, u.gender, u.country, u.email, 0, 'Active', cast('{RUN_TS}' as timestamp),
  cast('9999-12-31 00:00:00' as timestamp), u.file_name, cast('{RUN_TS}' as timestamp)
from fx_u u
union all
select a.id, a.name, a.dob, a.gender, a.country, a.email, 1, 'InActive', a.start_date,
  cast('{RUN_TS}' as timestamp), a.file_name, cast('{RUN_TS}' as timestamp)
from fx_a a where a.id in (select id from fx_u)
union all
select * from emp_target where id not in (select id from fx_u))"""


@register("two_version_merge_fixed", with_employees(f"with {TWO_VERSION_FIXED_CTES}\nselect * from two_version_fixed"))
def q_two_version_merge_fixed(spark, sf):
    return history.two_version_merge(emp_target(spark, sf), emp_batch(spark, sf), run_ts=RUN_TS, compat=False)


@register(
    "current_snapshot",
    with_employees(f"""with {TWO_VERSION_CTES}
select * from two_version where status = 'Active'
  and created_date >= cast('{RUN_DAY}' as timestamp) and created_date < cast('{RUN_DAY}' as timestamp) + interval 1 day"""),
)
def q_current_snapshot(spark, sf):
    return history.current_snapshot(two_version_state(spark, sf), day=RUN_DAY)


GOLD_COLS = ["id", "name", "dob", "gender", "country", "email", "status", "start_date", "end_date", "file_name", "created_date"]


@register(
    "publish_masked_snapshot",
    with_employees(f"""with {TWO_VERSION_CTES},
snap as (select * from two_version where status = 'Active'
  and created_date >= cast('{RUN_DAY}' as timestamp) and created_date < cast('{RUN_DAY}' as timestamp) + interval 1 day),
masked as (select id, name, dob, gender, country, {mask_sql('email')} as email, status, start_date, end_date,
  file_name, created_date from snap),
gold as (select {', '.join(GOLD_COLS)} from emp_target where status = 'Active')
select * from masked
union all
select * from gold g where not exists (select 1 from masked m where m.id = g.id)"""),
)
def q_publish_masked_snapshot(spark, sf):
    gold = emp_target(spark, sf).filter(F.col("status") == "Active").select(*GOLD_COLS)
    return history.publish_masked_snapshot(two_version_state(spark, sf), gold, day=RUN_DAY)


@register(
    "mask_email",
    with_employees(f"select id, email, {mask_sql('email')} as masked from emp_base"),
)
def q_mask_email(spark, sf):
    return employees(spark, sf).select("id", "email", mask_email(F.col("email")).alias("masked"))


# ------------------------------------------------------------------ M-08
@register(
    "versioned_history_merge",
    with_employees(f"""with
vt as (select id, name, email as mobile from emp_target where status = 'Active'),
vb as (select id, name, email as mobile from emp_batch)
select id, name, mobile, 0 as version, cast('{RUN_TS}' as timestamp) as datetime, 'Active' as status from vb
union all
select t.id, t.name, t.mobile, case when b.id is null then 0 else 1 end,
  cast('{RUN_TS}' as timestamp), case when b.id is null then 'Active' else 'InActive' end
from vt t left join vb b on t.id = b.id"""),
)
def q_versioned_history_merge(spark, sf):
    t = emp_target(spark, sf).filter(F.col("status") == "Active").select(
        "id", "name", F.col("email").alias("mobile"), F.col("eskey").alias("version"),
        F.col("created_date").alias("datetime"), "status")
    b = emp_batch(spark, sf).select("id", "name", F.col("email").alias("mobile"))
    return history.versioned_history_merge(t, b, run_ts=RUN_TS)


# ------------------------------------------------------------------ M-01 .. M-04
UPSERT_COLS = ["id", "name", "dob", "gender", "country", "email", "file_name"]


@register(
    "upsert_all",
    with_employees(f"""
select {', '.join(UPSERT_COLS)} from emp_batch
union all
select {', '.join(UPSERT_COLS)} from emp_target t
where status = 'Active' and not exists (select 1 from emp_batch b where b.id = t.id)"""),
)
def q_upsert_all(spark, sf):
    t = emp_target(spark, sf).filter(F.col("status") == "Active").select(*UPSERT_COLS)
    return merge.upsert_all(t, emp_batch(spark, sf), ["id"])


_MAPPED_COND = "s.name is distinct from t.name or s.country is distinct from t.country or s.email is distinct from t.email"


@register(
    "upsert_mapped",
    with_employees(f"""with
mt as (select {', '.join(UPSERT_COLS)} from emp_target where status = 'Active'),
mj as (select t.*, s.id as s_id, s.name as s_name, s.country as s_country, s.email as s_email,
         s.file_name as s_file_name,
         s.id is not null and ({_MAPPED_COND}) as m
       from mt t left join emp_batch s on t.id = s.id)
select id, case when m then s_name else name end as name, dob, gender,
  case when m then coalesce(s_country, country) else country end as country,
  case when m then s_email else email end as email,
  case when m then s_file_name else file_name end as file_name
from mj
union all
select s.id, s.name, s.dob, s.gender, coalesce(s.country, 'UNKNOWN'), s.email, s.file_name
from emp_batch s where not exists (select 1 from mt t where t.id = s.id)"""),
)
def q_upsert_mapped(spark, sf):
    t = emp_target(spark, sf).filter(F.col("status") == "Active").select(*UPSERT_COLS)
    return merge.upsert_mapped(
        t, emp_batch(spark, sf), ["id"],
        update_set={"name": "s.name", "country": "coalesce(s.country, t.country)", "email": "s.email",
                    "file_name": "s.file_name"},
        insert_values={"id": "s.id", "name": "s.name", "dob": "s.dob", "gender": "s.gender",
                       "country": "coalesce(s.country, 'UNKNOWN')", "email": "s.email", "file_name": "s.file_name"},
        matched_condition="not (s.name <=> t.name and s.country <=> t.country and s.email <=> t.email)",
    )


@register(
    "merge_delete",
    with_employees("""
select * from emp_target t
where not (t.status = 'InActive' and exists (select 1 from emp_batch b where b.id = t.id))"""),
)
def q_merge_delete(spark, sf):
    return merge.merge_delete(emp_target(spark, sf), emp_batch(spark, sf), ["id"], F.col("status") == "InActive")


@register(
    "merge_conflicts",
    "select o_custkey, o_orderdate, count(*) as n_rows from orders group by o_custkey, o_orderdate having count(*) > 1",
)
def q_merge_conflicts(spark, sf):
    o = table(spark, sf, "orders")
    return merge.merge_conflicts(o, ["o_custkey", "o_orderdate"])


# ------------------------------------------------------------------ J-02 / J-03
@register(
    "carry_forward_version",
    with_employees("""
select t.id, t.name, case when b.id is not null then 1 else t.eskey end as eskey,
  case when b.id is not null then 'InActive' else t.status end as status
from (select * from emp_target where status = 'Active') t
left join (select distinct id from emp_batch) b on t.id = b.id"""),
)
def q_carry_forward_version(spark, sf):
    t = emp_target(spark, sf).filter(F.col("status") == "Active").select("id", "name", "eskey", "status")
    return demote_matched(t, emp_batch(spark, sf), ["id"], version_col="eskey", status_col="status")


@register(
    "attach_existing_dates",
    with_employees("""with
r as (select id, name, 'Active' as status from emp_batch union all select id, name, 'InActive' from emp_batch)
select r.id, r.status, r.name, t.start_date, t.end_date, t.created_date
from r left join emp_target t on t.id = r.id and t.status = r.status"""),
)
def q_attach_existing_dates(spark, sf):
    b = emp_batch(spark, sf)
    rows = b.select("id", "name", F.lit("Active").alias("status")).unionByName(
        b.select("id", "name", F.lit("InActive").alias("status")))
    out = attach_columns(rows, emp_target(spark, sf), ["id", "status"], ["start_date", "end_date", "created_date"])
    return out.select("id", "status", "name", "start_date", "end_date", "created_date")


@register("two_version_merge_bucketed", with_employees(f"with {TWO_VERSION_CTES}\nselect * from two_version"))
def q_two_version_merge_bucketed(spark, sf):
    """The flagship on a stored table bucketed by key: load, then merge the
    batch by rewriting only the buckets its keys fall in."""
    target = emp_target(spark, sf)
    table = BucketedState(scratch_path(spark, "silver"), ["id"], target.schema, n_buckets=32)
    load(spark, table, target, batch_id=0)
    merge_in_place(spark, table, emp_batch(spark, sf), history.two_version_merge, batch_id=1,
                   run_ts=RUN_TS, compat=True)
    return table.current(spark)


@register(
    "classify_two_version",
    with_employees(f"""
select b.id,
  case when not exists (select 1 from emp_target t where t.id = b.id) then 'New'
       when exists (select 1 from emp_target i where i.id = b.id and i.status = 'InActive') then 'Update'
       when exists (select 1 from emp_target a where a.id = b.id and a.status = 'Active'
                    and ({_is_distinct(VALUES + ['file_name'], 'a', 'b')})) then 'Update'
       else 'Exist' end as change
from emp_batch b
union all
select distinct t.id, 'Exist' from emp_target t where not exists (select 1 from emp_batch b where b.id = t.id)"""),
)
def q_classify_two_version(spark, sf):
    """C-01 as the reference runs it: against the whole two-version table."""
    return history.two_version_changes(emp_target(spark, sf), emp_batch(spark, sf), compat=True)



@register("versioned_history_runs", with_employees(f"""with
c as (select id, name, email as mobile, -eskey as run from emp_target
      union all select id, name, email, 1 from emp_batch
      union all select id, name || ' v2', email, 2 from emp_base where id % 4 = 0
      union all select id, name || ' v3', email, 3 from emp_base where id % 6 in (1, 4)
      union all select id + 2000000, name || ' late', email, 3 from emp_base where id % 10 = 3),
r as (select *, row_number() over (partition by id order by run desc) - 1 as version from c)
select id, name, mobile, cast(version as int) as version, cast('{RUN_TS}' as timestamp) as datetime,
  case when version = 0 then 'Active' else 'InActive' end as status from r where version <= 1"""))
def q_versioned_history_runs(spark, sf):
    """M-08 with history in the table: three runs, the last with new keys too."""
    mobile = F.col("email").alias("mobile")
    t = emp_target(spark, sf).select("id", "name", mobile, F.col("eskey").alias("version"),
                                     F.col("created_date").alias("datetime"), "status")
    b = employees(spark, sf)
    second = b.filter("id % 4 = 0").select("id", F.concat("name", F.lit(" v2")).alias("name"), mobile)
    third = b.filter("id % 6 in (1, 4)").select("id", F.concat("name", F.lit(" v3")).alias("name"), mobile).unionByName(
        b.filter("id % 10 = 3").select((F.col("id") + 2000000).alias("id"), F.concat("name", F.lit(" late")).alias("name"), mobile))
    batches = [emp_batch(spark, sf).select("id", "name", mobile), second, third]
    return history.versioned_history_runs(t, batches, run_ts=RUN_TS)


@register(
    "changed_by_fingerprint",
    with_employees(f"""
select coalesce(s.id, t.id) as id,
  case when t.id is null then 'new' when s.id is null then 'missing'
       when {_is_distinct(VALUES, 't', 's')} then 'update' else 'unchanged' end as change
from (select * from emp_target where status = 'Active') t
full outer join emp_batch s on t.id = s.id"""),
)
def q_changed_by_fingerprint(spark, sf):
    """P-12 in two phases; the companion of fingerprints is a stored table."""
    t = emp_target(spark, sf).filter(F.col("status") == "Active")
    path = scratch_path(spark, "fingerprints")
    fingerprints.fingerprints(t, ["id"], VALUES).write.parquet(path)
    return fingerprints.changed_by_fingerprint(t, spark.read.parquet(path), emp_batch(spark, sf), ["id"], VALUES)
