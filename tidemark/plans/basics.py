"""Queries for the relational building blocks and scalar functions
(A-01, A-02, U-01, U-02, O-01, P-05, P-06, P-09, P-13 .. P-15, K-04, T-04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import basename
from tidemark.functions.time import CLOCK_FORMAT, format_ts, on_day, parse_mixed
from tidemark.operators.diff import key_conflicts
from tidemark.operators.filters import param_filter, stacked_filters
from tidemark.operators.publish import append_aligned
from tidemark.plans.fixtures import RUN_TS, emp_batch, emp_target, employees, table, with_employees
from tidemark.plans.registry import register


@register("group_count", with_employees("select gender, country, count(*) as n from emp_base group by gender, country"))
def q_group_count(spark, sf):
    return employees(spark, sf).groupBy("gender", "country").agg(F.count(F.lit(1)).alias("n"))


@register("duplicate_keys", with_employees("""
select id, count(*) as n from (select id from emp_target union all select id from emp_batch) x
group by id having count(*) > 2"""))
def q_duplicate_keys(spark, sf):
    ids = emp_target(spark, sf).select("id").unionByName(emp_batch(spark, sf).select("id"))
    return key_conflicts(ids, ["id"], min_count=3)


@register("union_by_name", with_employees("""
select * from emp_target
union all
select id, name, dob, gender, country, email, cast(null as int) as eskey, cast(null as varchar) as status,
  cast(null as timestamp) as start_date, cast(null as timestamp) as end_date, file_name,
  cast(null as timestamp) as created_date from emp_batch"""))
def q_union_by_name(spark, sf):
    return emp_target(spark, sf).unionByName(emp_batch(spark, sf), allowMissingColumns=True)


@register("distinct_rows", "select distinct user_id, event_type from events")
def q_distinct_rows(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type").dropDuplicates()


@register("ordered_listing", with_employees("select id, status, name from emp_target order by 1, 2 desc"))
def q_ordered_listing(spark, sf):
    return emp_target(spark, sf).select("id", "status", "name").orderBy(F.col("id"), F.col("status").desc())


@register("stacked_filters", with_employees("""
select id, name, dob, gender from emp_base where gender = 'F' and dob > 1990 and dob >= 2000"""))
def q_stacked_filters(spark, sf):
    b = employees(spark, sf).select("id", "name", "dob", "gender")
    return stacked_filters(b, ["gender = 'F' AND dob > 1990", "gender = 'F' AND dob >= 2000"])


@register("param_filter", with_employees("select id, name, dob, gender from emp_base where dob > 2005"))
def q_param_filter(spark, sf):
    b = employees(spark, sf).select("id", "name", "dob", "gender")
    return param_filter(b, "dob", ">", "2005")


DAY = "2024-01-03"


@register("rows_for_day", f"""select event_id, user_id, ts from events
where ts >= cast('{DAY}' as timestamp) and ts < cast('{DAY}' as timestamp) + interval 1 day""")
def q_rows_for_day(spark, sf):
    ev = table(spark, sf, "events")
    return ev.filter(on_day(F.col("ts"), DAY)).select("event_id", "user_id", "ts")


@register("format_timestamp", "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts_text from events")
def q_format_timestamp(spark, sf):
    return table(spark, sf, "events").select("event_id", format_ts(F.col("ts")).alias("ts_text"))


@register("url_basename", "select page_id, url, string_split(url, '/')[-1] as basename from pages")
def q_url_basename(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", basename(F.col("url")).alias("basename"))


# Timestamps as text in both layouts, every 97th one unreadable.
MIXED_TEXT_SQL = """select event_id,
  case when event_id % 97 = 0 then 'not a time'
       when event_id % 2 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S')
       else strftime(ts, '%Y-%m-%d %H:%M:%S') end as raw from events"""


@register("parse_mixed_timestamps", f"""select event_id, raw,
  cast(coalesce(try_strptime(raw, '%Y-%m-%dT%H:%M:%S'), try_strptime(raw, '%Y-%m-%d %H:%M:%S')) as date) as day,
  strftime(coalesce(try_strptime(raw, '%Y-%m-%dT%H:%M:%S'), try_strptime(raw, '%Y-%m-%d %H:%M:%S')), '%H:%M') as clock
from ({MIXED_TEXT_SQL}) m""")
def q_parse_mixed_timestamps(spark, sf):
    ev = table(spark, sf, "events")
    i = F.col("event_id")
    raw = (F.when(i % 97 == 0, "not a time")
           .when(i % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
           .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    t = parse_mixed(F.col("raw"))
    return ev.select("event_id", raw.alias("raw")).select(
        "event_id", "raw", F.to_date(t).alias("day"), F.date_format(t, CLOCK_FORMAT).alias("clock"))


@register("append_aligned", with_employees(f"""
select * from emp_target
union all
select id, name, dob, gender, country, email, 0, 'Active', cast('{RUN_TS}' as timestamp),
  cast(null as timestamp), file_name, cast(null as timestamp) from emp_batch"""))
def q_append_aligned(spark, sf):
    # the batch as a CSV read delivers it: every column text, names in any case
    b = emp_batch(spark, sf)
    text = b.select(*[F.col(c).cast("string").alias(c.upper() if c == "id" else c) for c in b.columns],
                    F.lit("0").alias("ESKey"), F.lit("Active").alias("Status"), F.lit(RUN_TS).alias("start_date"),
                    F.lit("ignored").alias("extra_column"))
    return append_aligned(emp_target(spark, sf), text)
