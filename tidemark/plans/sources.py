"""Queries for file sources (S-01, S-03, S-04, S-10) and streams (T-01 .. T-05)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import publish, quality
from tidemark.plans.cdc import EV_COLS, SCD2_TRACKED_SQL, _latest_sql
from tidemark.operators import history
from tidemark.plans.changes import TWO_VERSION_CTES
from tidemark.plans.fixtures import BASE_SQL, RUN_TS, emp_batch, emp_target, employees, table, with_employees
from tidemark.plans.landing import EVENT_COLS, EVENT_SCHEMA, land_events
from tidemark.plans.quality import EVENTS_TEXT_SQL, events_text
from tidemark.plans.registry import register
from tidemark.session import scratch_path
from tidemark.sources import files
from tidemark.streaming import cdc as scdc
from tidemark.streaming import keyed, metrics
from tidemark.streaming.ingest import append_stream, file_stream
from tidemark.streaming.state import BUCKET, BucketedState, load
from tidemark.streaming.typed import stream_typed

EMP_SCHEMA = "id bigint, name string, dob int, gender string, country string, email string"


@register("csv_roundtrip_scan", f"with emp_base as ({BASE_SQL}) select * from emp_base")
def q_csv_roundtrip_scan(spark, sf):
    root = scratch_path(spark, "csv_scan")
    files.write_csv(employees(spark, sf), f"{root}/employees")
    return files.read_csv(spark, f"{root}/employees", EMP_SCHEMA)


@register("file_provenance_counts", """select 'batch_' || cast(event_id % 3 as varchar) as source_dir,
  count(*) as n_rows from events group by 1""")
def q_file_provenance_counts(spark, sf):
    _, landing = land_events(spark, sf, "provenance", by_folder=True)
    df = files.with_provenance(files.read_csv(spark, f"{landing}/*", EVENT_SCHEMA))
    d = F.regexp_extract(F.col("file_path"), r"/([^/]+)/[^/]+$", 1)
    return df.groupBy(d.alias("source_dir")).agg(F.count(F.lit(1)).alias("n_rows"))


RESCUE_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
                "value": "double"}


@register("rescue_malformed", f"""select event_id, ts, user_id, event_type, try_cast(value as double) as value,
  case when value is not null and try_cast(value as double) is null
       then cast(json_object('value', value) as varchar) end as _rescued_data
from ({EVENTS_TEXT_SQL}) e""")
def q_rescue_malformed(spark, sf):
    text = events_text(spark, sf).select(*[F.col(c).cast("string") for c in RESCUE_TYPES])
    return files.rescue(text, RESCUE_TYPES)


# ---------------------------------------------------------------- streams
_EVENTS_SQL = f"select {', '.join(EVENT_COLS)} from events"


@register("stream_file_ingest", _EVENTS_SQL)
def q_stream_file_ingest(spark, sf):
    root, landing = land_events(spark, sf, "ingest")
    s = file_stream(spark, landing, EVENT_SCHEMA, max_files_per_trigger=1)
    append_stream(s, f"{root}/bronze", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/bronze")


@register("stream_append_sink", _EVENTS_SQL)
def q_stream_append_sink(spark, sf):
    """CSV sink; the second run on the same checkpoint must add nothing."""
    root, landing = land_events(spark, sf, "append_sink")
    for _ in range(2):
        s = file_stream(spark, landing, EVENT_SCHEMA)
        append_stream(s, f"{root}/out", f"{root}/_checkpoint", fmt="csv")
    return files.read_csv(spark, f"{root}/out", EVENT_SCHEMA)


@register("stream_inferred_schema", f"""select cast(event_id as int) as event_id, ts, cast(user_id as int) as user_id,
  event_type, value, props from events""")
def q_stream_inferred_schema(spark, sf):
    root, landing = land_events(spark, sf, "inferred")
    schema = files.stream_schema(spark, landing, f"{root}/_schema")
    # a restart reads the saved schema back instead of inferring again
    assert files.load_schema(spark, f"{root}/_schema") == schema
    s = file_stream(spark, landing, schema, max_files_per_trigger=1)
    append_stream(s, f"{root}/bronze", f"{root}/_checkpoint")
    out = spark.read.parquet(f"{root}/bronze")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("stream_cdc_scd1", _latest_sql("events", "user_id", "ts desc, event_id desc",
                                         ["user_id", "event_id", "ts", "event_type", "value"]))
def q_stream_cdc_scd1(spark, sf):
    root, landing = land_events(spark, sf, "stream_scd1")
    s = file_stream(spark, landing, EVENT_SCHEMA, max_files_per_trigger=1)
    state = scdc.stream_scd1(s, f"{root}/state", f"{root}/_checkpoint", ["user_id"], "ts", tiebreak=["event_id"],
                             columns=["event_id", "event_type", "value"], n_buckets=16)
    return state.current(spark).select("user_id", "event_id", "ts", "event_type", "value")


@register("stream_cdc_scd2", SCD2_TRACKED_SQL + "\nselect * from h")
def q_stream_cdc_scd2(spark, sf):
    root, landing = land_events(spark, sf, "stream_scd2")
    s = file_stream(spark, landing, EVENT_SCHEMA, max_files_per_trigger=1)
    state = scdc.stream_scd2(s, f"{root}/cdc", f"{root}/_checkpoint", ["user_id"], "ts",
                             track_columns=["event_type"], tiebreak=["event_id"], columns=EV_COLS, n_buckets=16)
    return state.current(spark).select("user_id", *EV_COLS, "__START_AT", "__END_AT")


@register("stream_current_snapshot", SCD2_TRACKED_SQL + "\nselect * from h where __END_AT is null")
def q_stream_current_snapshot(spark, sf):
    """T-07: gold follows the type 2 table: open versions, refreshed per micro-batch."""
    root, landing = land_events(spark, sf, "stream_current")
    s = file_stream(spark, landing, EVENT_SCHEMA, max_files_per_trigger=1)
    scdc.stream_scd2(s, f"{root}/cdc", f"{root}/_checkpoint", ["user_id"], "ts", track_columns=["event_type"],
                     tiebreak=["event_id"], columns=EV_COLS, n_buckets=16, current_root=f"{root}/gold")
    gold = spark.read.parquet(f"{root}/gold/data").drop(BUCKET)
    return gold.select("user_id", *EV_COLS, "__START_AT", "__END_AT")


DROP_RULES = {"event type present": "event_type is not null", "value is a number": "value is not null"}
FAIL_RULES = {"no rescued data": f"{files.RESCUE} is null"}


@register("stream_medallion", f"""select event_id, ts, user_id, event_type, cast(value as double) as value,
  cast(null as varchar) as _rescued_data
from ({EVENTS_TEXT_SQL}) e where event_type is not null and try_cast(value as double) is not null""")
def q_stream_medallion(spark, sf):
    """T-03: raw files -> bronze (typed + rescued data) -> view (drop rules)
    -> silver -> gold (fail rule).  Views are lazy plans; tables are
    materialised streams with their own checkpoints."""
    text = events_text(spark, sf).select(*[F.col(c).cast("string") for c in RESCUE_TYPES])
    root, landing = land_events(spark, sf, "medallion", events=text)
    raw_schema = T.StructType([T.StructField(c, T.StringType()) for c in RESCUE_TYPES])
    raw = file_stream(spark, landing, raw_schema, max_files_per_trigger=1)
    append_stream(files.rescue(raw, RESCUE_TYPES), f"{root}/bronze", f"{root}/_ck_bronze")

    bronze_schema = spark.read.parquet(f"{root}/bronze").schema
    view = quality.expect_or_drop(spark.readStream.schema(bronze_schema).parquet(f"{root}/bronze"), DROP_RULES)
    append_stream(view, f"{root}/silver", f"{root}/_ck_silver")

    gold = quality.expect_or_fail(spark.readStream.schema(bronze_schema).parquet(f"{root}/silver"), FAIL_RULES)
    append_stream(gold, f"{root}/gold", f"{root}/_ck_gold")
    return spark.read.parquet(f"{root}/gold")


@register("stream_two_version_merge", with_employees(f"with {TWO_VERSION_CTES}\nselect * from two_version"))
def q_stream_two_version_merge(spark, sf):
    """The flagship as a stream: the batch lands as three CSV files (split by
    key, arriving out of key order) and each micro-batch is one bucketed
    two-version merge commit on the stored silver table."""
    root = scratch_path(spark, "stream_two_version")
    batch = emp_batch(spark, sf)
    for k in (2, 0, 1):
        files.write_csv(batch.filter(F.col("id") % 3 == k), f"{root}/landing", mode="append")
    target = emp_target(spark, sf)
    silver = BucketedState(f"{root}/silver", ["id"], target.schema, n_buckets=16)
    load(spark, silver, target, batch_id=-1)
    s = file_stream(spark, f"{root}/landing", batch.schema, max_files_per_trigger=1)
    scdc.stream_merge(s, silver, f"{root}/_checkpoint", history.two_version_merge, run_ts=RUN_TS, compat=True)
    return silver.current(spark)


@register("rescue_broken_lines", """select event_id, value, event_id % 23 = 0 as broken from events""")
def q_rescue_broken_lines(spark, sf):
    """S-04, structural case: ``events`` as raw CSV lines, every 23rd with an
    extra field; the reader keeps the values it can and files the whole line
    under ``_corrupt_record`` in ``_rescued_data``."""
    root = scratch_path(spark, "broken_lines")
    ev = table(spark, sf, "events")
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.col("value").cast("string"))
    line = F.when(F.col("event_id") % 23 == 0, F.concat(line, F.lit(",extra"))).otherwise(line)
    ev.select(line.alias("value")).write.mode("overwrite").text(f"{root}/raw")
    out = files.read_csv_rescued(spark, f"{root}/raw", {"event_id": "bigint", "value": "double"}, header=False)
    broken = F.coalesce(F.col(files.RESCUE).contains(files.CORRUPT), F.lit(False))
    return out.select("event_id", "value", broken.alias("broken"))



TEXT_COLS = ["event_id", "ts", "user_id", "event_type", "value"]
# the second load: users beyond 32 bits, every 17th value malformed, every 23rd line with one more field
_LINES_SQL = """l as (select *, case when event_id % 3 = 0 then user_id + 3000000000 else user_id end as u,
  case when event_id % 3 = 0 and event_id % 17 = 0 then 'xx' else cast(value as varchar) end as v from events),
t as (select *, concat_ws(',', event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), u, event_type, v) || ',extra' as line,
  event_id % 3 = 0 and event_id % 23 = 0 as broken from l)"""


@register("stream_text_rescue", f"""with {_LINES_SQL}
select cast(event_id as int) as event_id, ts, u as user_id, event_type, try_cast(v as double) as value,
  case when v = 'xx' and broken then cast(json_object('value', v, '_corrupt_record', line) as varchar)
       when v = 'xx' then cast(json_object('value', v) as varchar)
       when broken then cast(json_object('_corrupt_record', line) as varchar) end as _rescued_data
from t""")
def q_stream_text_rescue(spark, sf):
    """S-03 + S-04 on a stream: three loads of text lines, each a run of its own
    on one checkpoint; the second widens a type and holds bad values and lines."""
    root = scratch_path(spark, "text_rescue")
    ev = table(spark, sf, "events")
    second, i = F.col("event_id") % 3 == 0, F.col("event_id")
    user = F.when(second, F.col("user_id") + 3000000000).otherwise(F.col("user_id"))
    value = F.when(second & (i % 17 == 0), "xx").otherwise(F.col("value").cast("string"))
    line = F.concat_ws(",", i.cast("string"), F.date_format("ts", files.TS_FORMAT), user.cast("string"), "event_type", value)
    lines = ev.select(i, F.when(second & (i % 23 == 0), F.concat(line, F.lit(",extra"))).otherwise(line).alias("value"))
    for k in (2, 0, 1):
        lines.filter(F.col("event_id") % 3 == k).select("value").write.mode("append").text(f"{root}/landing")
        events = stream_typed(spark, f"{root}/landing", f"{root}/events", f"{root}/_checkpoint", names=TEXT_COLS, header=False)
    return events.read()


PART_ROWS = 700


@register("export_parts", f"""with p as (select o_orderkey, o_custkey, o_totalprice,
  row_number() over (order by o_orderdate, o_orderkey) - 1 as pos from orders)
select o_orderkey, o_custkey, o_totalprice, 'orders_' || lpad(cast(pos // {PART_ROWS} as varchar), 6, '0') || '.csv' as file_name,
  pos % {PART_ROWS} as place from p""")
def q_export_parts(spark, sf):
    """K-06 / K-07 without a cap: orders by date as CSV parts of 700 rows, read back."""
    folder = scratch_path(spark, "export")
    o = table(spark, sf, "orders").select("o_orderdate", "o_orderkey", "o_custkey", "o_totalprice")
    publish.export_parts(o, folder, ["o_orderdate", "o_orderkey"], PART_ROWS, name="orders", place_col="place")
    back = files.read_csv(spark, f"{folder}/orders_*.csv", T.StructType([*o.schema.fields, T.StructField("place", T.LongType())]))
    return files.with_provenance(back, path_col=None).select("o_orderkey", "o_custkey", "o_totalprice", "file_name", "place")


@register("stream_scd1_stateful", _latest_sql("events", "user_id", "ts desc, event_id desc",
                                              ["user_id", "event_id", "ts", "event_type", "value"]))
def q_stream_scd1_stateful(spark, sf):
    """T-05 with keyed state: files out of order, in two runs on one checkpoint."""
    root = scratch_path(spark, "scd1_stateful")
    ev = table(spark, sf, "events").select(*EVENT_COLS)
    for part in (F.col("event_id") % 3 == 2, F.col("event_id") % 3 < 2):
        files.write_csv(ev.filter(part), f"{root}/landing", mode="append")
        s = file_stream(spark, f"{root}/landing", EVENT_SCHEMA)
        keyed.stream_scd1_stateful(s, root, f"{root}/_checkpoint", ["user_id"], "ts", tiebreak=["event_id"],
                                   columns=["event_id", "event_type", "value"])
    return keyed.current(spark, f"{root}/_checkpoint").select("user_id", "event_id", "ts", "event_type", "value")


RULES = {"value is positive": "value > 0", "known event type": "event_type in ('view', 'click', 'signup', 'purchase')",
         "value below 300": "value < 300"}


@register("expectation_log", "\nunion all\n".join(
    f"select cast({b} as bigint) as batch_id, '{name}' as rule, count(*) as n_rows, "
    f"count(*) filter (where not coalesce({p}, false)) as n_failed from events where event_id % 3 = {k}"
    for b, k in enumerate((2, 0, 1)) for name, p in RULES.items()))
def q_expectation_log(spark, sf):
    """Q-01 on a stream: the failures of three micro-batches, a run each, and of a
    restart that finds nothing new, as rows kept by a listener."""
    root = scratch_path(spark, "expectation_log")
    ev = table(spark, sf, "events").select(*EVENT_COLS)
    with metrics.keep_expectations(spark, f"{root}/log"):
        for k in (2, 0, 1, None):
            if k is not None:
                files.write_csv(ev.filter(F.col("event_id") % 3 == k), f"{root}/landing", mode="append")
            s = quality.expect(file_stream(spark, f"{root}/landing", EVENT_SCHEMA), RULES, observation="rules")
            append_stream(s, f"{root}/out", f"{root}/_checkpoint")
    return metrics.read_expectations(spark, f"{root}/log").select("batch_id", "rule", "n_rows", "n_failed")
