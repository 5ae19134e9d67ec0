"""Queries for CDC apply (M-06, M-07) and views over intervals (M-10, M-11)."""

from __future__ import annotations


from pyspark.sql import functions as F

from tidemark.operators import cdc, history
from tidemark.operators.asof import as_of_each
from tidemark.plans.fixtures import table
from tidemark.plans.registry import register

AS_OF = "2024-01-05 12:00:00"
EV_COLS = ["event_id", "ts", "event_type", "value", "props"]


def _latest_sql(tbl: str, key: str, order: str, cols: list[str]) -> str:
    return f"""select {', '.join(cols)} from (
  select *, row_number() over (partition by {key} order by {order}) as rn from {tbl}) x
where rn = 1"""


@register("cdc_scd1", _latest_sql("events", "user_id", "ts desc, event_id desc",
                                  ["user_id", "event_id", "ts", "event_type", "value"]))
def q_cdc_scd1(spark, sf):
    ev = table(spark, sf, "events")
    return cdc.scd1(ev, ["user_id"], "ts", tiebreak=["event_id"], columns=["event_id", "event_type", "value"]) \
        .select("user_id", "event_id", "ts", "event_type", "value")


@register("cdc_scd1_ties", _latest_sql("orders", "o_custkey", "o_orderdate desc, o_orderkey desc",
                                       ["o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"]))
def q_cdc_scd1_ties(spark, sf):
    o = table(spark, sf, "orders")
    return cdc.scd1(o, ["o_custkey"], "o_orderdate", tiebreak=["o_orderkey"],
                    columns=["o_orderkey", "o_orderstatus", "o_totalprice"]) \
        .select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")


def _scd2_sql(tbl: str, key: str, order: list[str], track: list[str], cols: list[str]) -> str:
    o = ", ".join(order)
    w = f"partition by {key} order by {o}"
    changed = " or ".join(f"{c} is distinct from prev_{c}" for c in track)
    lags = ", ".join(f"lag({c}) over ({w}) as prev_{c}" for c in track)
    last = ", ".join(f"max_by({c}, row({o})) as {c}" for c in cols)
    return f"""with e as (select *, {lags}, row_number() over ({w}) as rn from {tbl}),
r as (select *, sum(case when rn = 1 or {changed} then 1 else 0 end)
        over ({w} rows between unbounded preceding and current row) as run_id from e),
g as (select {key}, run_id, min({order[0]}) as __START_AT, {last} from r group by {key}, run_id),
h as (select {key}, {', '.join(cols)}, __START_AT,
        lead(__START_AT) over (partition by {key} order by run_id) as __END_AT from g)"""


SCD2_TRACKED_SQL = _scd2_sql("events", "user_id", ["ts", "event_id"], ["event_type"], EV_COLS)


def scd2_tracked_state(spark, sf):
    ev = table(spark, sf, "events")
    return cdc.scd2(ev, ["user_id"], "ts", track_columns=["event_type"], tiebreak=["event_id"], columns=EV_COLS)


@register("cdc_scd2_tracked", SCD2_TRACKED_SQL + "\nselect * from h")
def q_cdc_scd2_tracked(spark, sf):
    return scd2_tracked_state(spark, sf)


@register("cdc_scd2_tracked_windowed", SCD2_TRACKED_SQL + "\nselect * from h")
def q_cdc_scd2_tracked_windowed(spark, sf):
    ev = table(spark, sf, "events")
    return cdc.scd2_windowed(ev, ["user_id"], "ts", track_columns=["event_type"], tiebreak=["event_id"],
                             columns=EV_COLS)


@register("cdc_scd2", _scd2_sql("events", "user_id", ["ts", "event_id"], ["event_type", "value", "props"], EV_COLS)
          + "\nselect * from h")
def q_cdc_scd2(spark, sf):
    ev = table(spark, sf, "events")
    return cdc.scd2(ev, ["user_id"], "ts", tiebreak=["event_id"], columns=EV_COLS)


ORD_COLS = ["o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"]


@register("cdc_scd2_sequence_only",
          _scd2_sql("orders", "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderdate"], ORD_COLS)
          + "\nselect * from h")
def q_cdc_scd2_sequence_only(spark, sf):
    """The reference tracks only the sequence column: every new load value opens a version."""
    o = table(spark, sf, "orders")
    return cdc.scd2(o, ["o_custkey"], "o_orderdate", track_columns=["o_orderdate"], tiebreak=["o_orderkey"],
                    columns=ORD_COLS)


@register("history_as_of", SCD2_TRACKED_SQL + f"""
select * from h where __START_AT <= cast('{AS_OF}' as timestamp)
  and (__END_AT is null or cast('{AS_OF}' as timestamp) < __END_AT)""")
def q_history_as_of(spark, sf):
    return history.as_of(scd2_tracked_state(spark, sf), AS_OF)


@register("close_open_intervals", SCD2_TRACKED_SQL + """
select user_id, event_id, ts, event_type, value, props, __START_AT,
  coalesce(__END_AT, cast('9999-12-31 00:00:00' as timestamp)) as __END_AT from h""")
def q_close_open_intervals(spark, sf):
    return history.close_open_intervals(scd2_tracked_state(spark, sf))


@register("open_versions", SCD2_TRACKED_SQL + "\nselect * from h where __END_AT is null")
def q_open_versions(spark, sf):
    return history.open_versions(scd2_tracked_state(spark, sf))


# A third of all changes re-keyed to one user: the skew case.  The threshold
# is set so the hot key takes the chunked path at every scale of the tables.
HOT_EVENTS_SQL = """select event_id, ts, case when event_id % 3 = 0 then 0 else user_id end as user_id,
  event_type, value, props from events"""


def hot_events(spark, sf):
    ev = table(spark, sf, "events")
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("bigint"))
                         .otherwise(F.col("user_id")))


@register("cdc_scd2_hot_key",
          _scd2_sql(f"({HOT_EVENTS_SQL})", "user_id", ["ts", "event_id"], ["event_type"], EV_COLS)
          + "\nselect * from h")
def q_cdc_scd2_hot_key(spark, sf):
    ev = hot_events(spark, sf)
    return cdc.scd2(ev, ["user_id"], "ts", track_columns=["event_type"], tiebreak=["event_id"], columns=EV_COLS,
                    hot_key_rows=1000)



@register("history_as_of_each", _scd2_sql(f"({HOT_EVENTS_SQL})", "user_id", ["ts", "event_id"], ["event_type"], EV_COLS)
          + f""",
q as (select event_id as asked, user_id, ts + interval 45 minute as instant from ({HOT_EVENTS_SQL}) x),
v as (select user_id, event_id, event_type, __START_AT, __END_AT from h
      where __END_AT is null or __START_AT < __END_AT)
select asked, q.user_id, instant, event_id, event_type, __START_AT, __END_AT
from q asof left join v on q.user_id = v.user_id and q.instant >= v.__START_AT""")
def q_history_as_of_each(spark, sf):
    """M-10 for a column of instants: the version of its user 45 minutes after
    every event; one user has a third of all versions and instants."""
    ev = hot_events(spark, sf)
    versions = cdc.scd2(ev, ["user_id"], "ts", track_columns=["event_type"], tiebreak=["event_id"], columns=EV_COLS,
                        hot_key_rows=1000)
    asks = ev.select(F.col("event_id").alias("asked"), "user_id", (F.col("ts") + F.expr("interval 45 minutes")).alias("instant"))
    return as_of_each(versions, asks, ["user_id"], "instant", columns=["event_id", "event_type", "__START_AT", "__END_AT"])
