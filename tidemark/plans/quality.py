"""Queries for expectations, quarantine, file-name rules and routing (Q-*, K-13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.contract import ContractTable
from tidemark.operators.intake import Intake, NothingAccepted
from tidemark.plans.fixtures import emp_batch, employees, table, with_employees
from tidemark.plans.registry import register
from tidemark.session import scratch_path


def _counts_sql(tbl: str, rules: dict[str, str]) -> str:
    parts = [
        f"select '{name}' as rule, count(*) as n_rows, count(*) filter (where not coalesce({pred}, false)) as n_failed "
        f"from {tbl}"
        for name, pred in rules.items()
    ]
    return "\nunion all\n".join(parts)


EVENT_RULES = {
    "value is positive": "value > 0",
    "known event type": "event_type in ('view', 'click', 'signup', 'purchase')",
    "value below 300": "value < 300",
}


@register("expect_warn_counts", _counts_sql("events", EVENT_RULES))
def q_expect_warn_counts(spark, sf):
    return quality.failure_counts(table(spark, sf, "events"), EVENT_RULES)


# Text view of events: every 17th value is malformed (FIXTURES.md §2).
EVENTS_TEXT_SQL = """select event_id, ts, user_id, event_type,
  case when event_id % 17 = 0 then 'xx' else cast(value as varchar) end as value from events"""


def events_text(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", "ts", "user_id", "event_type",
                     F.when(F.col("event_id") % 17 == 0, "xx").otherwise(F.col("value").cast("string")).alias("value"))


DROP_RULES = {
    "event type present": "event_type is not null",
    "value is a number": "try_cast(value as double) is not null",
}


@register("expect_or_drop", f"""select event_id, event_type, cast(value as double) as value
from ({EVENTS_TEXT_SQL}) e
where event_type is not null and try_cast(value as double) is not null""")
def q_expect_or_drop(spark, sf):
    kept = quality.expect_or_drop(events_text(spark, sf), DROP_RULES)
    return kept.select("event_id", "event_type", F.col("value").cast("double").alias("value"))


LABEL_RULES = {"quality is binary": "quality in (0, 1)", "toxic is binary": "toxic in (0, 1)"}


@register("expect_or_fail", "select doc_id, quality, toxic from labels")
def q_expect_or_fail(spark, sf):
    return quality.expect_or_fail(table(spark, sf, "labels"), LABEL_RULES)


DOC_RULES = {
    "text present": "text is not null and length(text) > 0",
    "size in range": "n_chars between 10 and 20000",
    "known language": "lang in ('en', 'de', 'fr', 'es')",
}


@register("quarantine_rows", f"""select * from (
select doc_id, lang, n_chars, concat_ws(',', {', '.join(f"case when not coalesce({p}, false) then '{n}' end" for n, p in DOC_RULES.items())}) as failed
from documents) d where failed <> ''""")
def q_quarantine_rows(spark, sf):
    _, bad = quality.quarantine(table(spark, sf, "documents"), DOC_RULES)
    return bad.select("doc_id", "lang", "n_chars", F.array_join(quality.FAILED, ",").alias("failed"))


@register("quarantine_kept", f"""select doc_id, lang, n_chars from documents
where {' and '.join(f"coalesce({p}, false)" for p in DOC_RULES.values())}""")
def q_quarantine_kept(spark, sf):
    good, _ = quality.quarantine(table(spark, sf, "documents"), DOC_RULES)
    return good.select("doc_id", "lang", "n_chars")


REQUIRED = ["id", "name", "dob", "gender", "country", "email"]


@register("not_null_violations", with_employees(_counts_sql("emp_base", {f"{c} is not null": f"{c} is not null" for c in REQUIRED})))
def q_not_null_violations(spark, sf):
    return quality.failure_counts(employees(spark, sf), quality.not_null_rules(REQUIRED))


# File names derived from orders: origin by key, stamp = order date, some
# with a wrong extension and some with the reference's loose-pattern trap.
RUN_DATE = "19970101"
FILE_NAME_SQL = """select o_orderkey,
  case o_orderkey % 4 when 0 then 'EmployeeData' when 1 then 'PayrollData' when 2 then 'BranchData' else 'Other' end
  || '_' || strftime(o_orderdate, '%Y%m%d') ||
  case when o_orderkey % 7 = 0 then 'Xcsv_' || strftime(o_orderdate, '%Y%m%d') || '.csv'
       when o_orderkey % 5 = 0 then '.txt' else '.csv' end as file_name
from orders"""


def file_names(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    stamp = F.date_format("o_orderdate", "yyyyMMdd")
    prefix = F.when(k % 4 == 0, "EmployeeData").when(k % 4 == 1, "PayrollData").when(k % 4 == 2, "BranchData").otherwise("Other")
    ext = F.when(k % 7 == 0, F.concat(F.lit("Xcsv_"), stamp, F.lit(".csv"))).when(k % 5 == 0, ".txt").otherwise(".csv")
    return o.select("o_orderkey", F.concat(prefix, F.lit("_"), stamp, ext).alias("file_name"))


@register("validate_origin_names", f"""select o_orderkey, file_name,
  regexp_matches(file_name, '^(EmployeeData|PayrollData|BranchData)_[0-9]{{8}}\\.csv$')
    and regexp_extract(file_name, '_([0-9]{{8}})\\.csv$', 1) = '{RUN_DATE}' as valid_strict,
  regexp_matches(file_name, '^(EmployeeData_[0-9]{{8}}.csv|PayrollData_[0-9]{{8}}.csv|BranchData_[0-9]{{8}}.csv)')
    and contains(file_name, '{RUN_DATE}') as valid_compat
from ({FILE_NAME_SQL}) f""")
def q_validate_origin_names(spark, sf):
    n = F.col("file_name")
    return file_names(spark, sf).select(
        "o_orderkey", "file_name",
        quality.valid_origin_name(n, RUN_DATE).alias("valid_strict"),
        quality.valid_origin_name(n, RUN_DATE, compat=True).alias("valid_compat"),
    )


@register("route_files", f"""select route, count(*) as n_files from (
select case when not ends_with(file_name, '.csv') then 'ignored'
  when regexp_matches(file_name, '^(EmployeeData|PayrollData|BranchData)_[0-9]{{8}}\\.csv$')
    and regexp_extract(file_name, '_([0-9]{{8}})\\.csv$', 1) = '{RUN_DATE}' then 'accepted'
  else 'rejected' end as route
from ({FILE_NAME_SQL}) f) r group by route""")
def q_route_files(spark, sf):
    routed = quality.route_files(file_names(spark, sf), "file_name", RUN_DATE)
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n_files"))


ORIGIN_ROUTES = [
    ("csv_export", "file_name like 'EmployeeData%' or file_name like 'BranchData%'"),
    ("jdbc_export", "file_name like 'PayrollData%'"),
]


@register("route_by_origin", with_employees("""
select id, file_name, case when file_name like 'EmployeeData%' or file_name like 'BranchData%' then 'csv_export'
  when file_name like 'PayrollData%' then 'jdbc_export' else 'unrouted' end as route from emp_batch"""))
def q_route_by_origin(spark, sf):
    return quality.route_by(emp_batch(spark, sf), ORIGIN_ROUTES, default="unrouted").select("id", "file_name", "route")


@register("intake_outcome", f"""select route, count(*) as n_rows, count(*) as n_counted, count(distinct file_name) as n_files from (
select file_name, case when not ends_with(file_name, '.csv') then 'ignored'
  when regexp_matches(file_name, '^(EmployeeData|PayrollData|BranchData)_[0-9]{{8}}\\.csv$')
    and regexp_extract(file_name, '_([0-9]{{8}})\\.csv$', 1) = '{RUN_DATE}' then 'accepted'
  else 'rejected' end as route
from ({FILE_NAME_SQL}) f) r group by route""")
def q_intake_outcome(spark, sf):
    """K-13 + Q-07: rows of many files written to their routes in one pass; rows
    and files read back beside the counts of the write."""
    routed = quality.route_files(file_names(spark, sf), "file_name", RUN_DATE)
    intake = Intake(scratch_path(spark, "intake"))
    try:
        counts = intake.write(routed, "1")
    except NothingAccepted as stop:  # small tables have no file of the day: nothing may be visible then
        counts = stop.counts
        seen = routed
    else:
        seen = None
        for r in intake.routes:
            part = intake.read(spark, r, routed.schema)
            seen = part if seen is None else seen.unionByName(part)
    told = spark.createDataFrame(sorted(counts.items()), "route string, n_counted long")
    return (seen.groupBy("route").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("file_name").alias("n_files"))
            .join(told, "route").select("route", "n_rows", "n_counted", "n_files"))


EMPLOYEE_CONTRACT = "id bigint not null, name string not null, dob int not null, gender string not null, country string, email string"


@register("contract_checked_write", with_employees("""
select * from emp_base union all select id + 1000000, name, dob, gender, country, email from emp_batch where id % 2 = 0"""))
def q_contract_checked_write(spark, sf):
    """K-01 + Q-05: a table created from DDL; a good batch is appended, a batch
    with rows that break the contract leaves the table as it was."""
    t = ContractTable.create(spark, scratch_path(spark, "contract"), EMPLOYEE_CONTRACT)
    good = employees(spark, sf)
    t.append(good)
    try:
        t.append(good.withColumn("gender", F.when(F.col("id") % 100 != 7, F.col("gender"))))
    except Exception as refused:  # noqa: BLE001 - the kind of error depends on the client
        if "gender is not null" not in str(refused):
            raise
    else:
        raise AssertionError("rows without a required value were written")
    more = emp_batch(spark, sf).filter("id % 2 = 0").withColumn("id", F.col("id") + 1000000).drop("file_name")
    ContractTable.open(spark, t.root).append(more)
    return t.read()
