"""Inputs derived from the driver's tables, in both Spark and SQL form.

The employee views map ``customer`` / ``nation`` onto the record shape the
change-data operators work on (id, name, dob, gender, country, email).  The SQL
text is inlined as CTEs into every oracle query; the DataFrame builders express
the same rows with the DataFrame API so Catalyst prunes and pushes down into the
parquet scans.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values of the employee views (see FIXTURES.md §2).
TARGET_LOAD_TS = "2024-01-01 00:00:00"
PREVIOUS_START_TS = "2023-06-01 00:00:00"
FAR_END_TS = "9999-12-31 00:00:00"
RUN_TS = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's table ``name``.  The DataFrame (listing, footer, schema) is
    kept per session: the test tables are read-only, and every query reads a
    few of them."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    cache = spark.__dict__.setdefault("_tidemark_tables", {})
    if path not in cache:
        cache[path] = spark.read.parquet(path)
    return cache[path]


def ts(text: str) -> Column:
    """A timestamp literal without time zone (equal to SQL ``TIMESTAMP``)."""
    return F.lit(text).cast("timestamp_ntz")


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    k = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        k.alias("id"),
        F.col("c_name").alias("name"),
        (F.lit(1960) + k % 60).cast("int").alias("dob"),
        F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("country"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lower("c_mktsegment"), k.cast("string"), F.lit("@example.org")))
        .alias("email"),
    )


def emp_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = employees(spark, sf_dir)
    active = b.select(
        "id", "name", "dob", "gender", "country", "email",
        F.lit(0).alias("eskey"), F.lit("Active").alias("status"),
        ts(TARGET_LOAD_TS).alias("start_date"), ts(FAR_END_TS).alias("end_date"),
        F.lit("EmployeeData_20240101.csv").alias("file_name"), ts(TARGET_LOAD_TS).alias("created_date"),
    )
    previous = b.filter(F.col("id") % 5 == 0).select(
        "id", F.concat("name", F.lit(" old")).alias("name"), "dob", "gender", "country", "email",
        F.lit(1).alias("eskey"), F.lit("InActive").alias("status"),
        ts(PREVIOUS_START_TS).alias("start_date"), ts(TARGET_LOAD_TS).alias("end_date"),
        F.lit("EmployeeData_20230601.csv").alias("file_name"), ts(TARGET_LOAD_TS).alias("created_date"),
    )
    return active.unionByName(previous)


def emp_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = employees(spark, sf_dir)
    i = F.col("id")
    kept = b.filter(i % 3 != 0).select(
        "id", "name", "dob", "gender",
        F.when(i % 7 == 0, "MOVED").otherwise(F.col("country")).alias("country"),
        "email",
        F.when(i % 4 == 0, "PayrollData_20240201.csv")
        .when(i % 4 == 1, "BranchData_20240201.csv")
        .otherwise("EmployeeData_20240101.csv").alias("file_name"),
    )
    new = b.filter(i % 10 == 0).select(
        (i + 1000000).alias("id"), F.concat("name", F.lit(" new")).alias("name"),
        "dob", "gender", "country", "email", F.lit("EmployeeData_20240201.csv").alias("file_name"),
    )
    return kept.unionByName(new)


# ---------------------------------------------------------------- SQL forms
BASE_SQL = """select c_custkey as id, c_name as name, cast(1960 + c_custkey % 60 as int) as dob,
  case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
  case when c_custkey % 11 = 0 then cast(null as varchar) else n_name end as country,
  case when c_custkey % 13 = 0 then cast(null as varchar)
       else concat(lower(c_mktsegment), cast(c_custkey as varchar), '@example.org') end as email
from customer join nation on c_nationkey = n_nationkey"""

EMP_TARGET_SQL = f"""select id, name, dob, gender, country, email, 0 as eskey, 'Active' as status,
  cast('{TARGET_LOAD_TS}' as timestamp) as start_date,
  cast('{FAR_END_TS}' as timestamp) as end_date,
  'EmployeeData_20240101.csv' as file_name,
  cast('{TARGET_LOAD_TS}' as timestamp) as created_date
from emp_base
union all
select id, concat(name, ' old'), dob, gender, country, email, 1, 'InActive',
  cast('{PREVIOUS_START_TS}' as timestamp), cast('{TARGET_LOAD_TS}' as timestamp),
  'EmployeeData_20230601.csv', cast('{TARGET_LOAD_TS}' as timestamp)
from emp_base where id % 5 = 0"""

EMP_BATCH_SQL = """select id, name, dob, gender, case when id % 7 = 0 then 'MOVED' else country end as country, email,
  case when id % 4 = 0 then 'PayrollData_20240201.csv'
       when id % 4 = 1 then 'BranchData_20240201.csv'
       else 'EmployeeData_20240101.csv' end as file_name
from emp_base where id % 3 <> 0
union all
select id + 1000000, concat(name, ' new'), dob, gender, country, email, 'EmployeeData_20240201.csv'
from emp_base where id % 10 = 0"""


def with_employees(body: str) -> str:
    """Prefix an oracle query with the employee views as CTEs.

    A body that has its own ``with`` list is appended to ours.
    """
    body = body.strip()
    if re.match(r"with\s", body, re.IGNORECASE):
        body = "," + body[4:]
    return (
        f"with emp_base as ({BASE_SQL}),\n"
        f"emp_target as ({EMP_TARGET_SQL}),\n"
        f"emp_batch as ({EMP_BATCH_SQL})\n"
        f"{body}"
    )
