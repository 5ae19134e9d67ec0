"""The README's batch workflow, end to end on the employee fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.operators import history, publish, quality
from tidemark.plans.fixtures import emp_batch, emp_target
from tidemark.sources import files

RAW = "ID string, Name string, DOB string, Gender string, Country string, Email string"


def test_readme_batch_flow(spark, tmp_path):
    landing = str(tmp_path / "landing")
    batch = emp_batch(spark, SMALL).select(
        F.col("id").cast("string").alias("ID"), F.col("name").alias("Name"), F.col("dob").cast("string").alias("DOB"),
        F.col("gender").alias("Gender"), F.col("country").alias("Country"), F.col("email").alias("Email"))
    good = batch.filter(F.col("ID").cast("long") % 2 == 0)
    publish.export_single_csv(good.filter(F.col("ID").cast("long") % 4 == 0), landing, "EmployeeData_20250601.csv")
    publish.export_single_csv(good.filter(F.col("ID").cast("long") % 4 == 2), landing, "PayrollData_20250601.csv")
    publish.export_single_csv(batch.filter(F.col("ID").cast("long") % 2 == 1), landing, "Unknown_20250601.csv")
    publish.export_single_csv(batch.limit(3), landing, "notes.txt")

    raw = files.with_provenance(files.read_csv(spark, f"{landing}/*", RAW))
    raw = quality.route_files(raw, "file_name", "20250601")
    routes = {r.route: r.n for r in raw.groupBy("route").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert routes == {"accepted": good.count(), "rejected": batch.count() - good.count(), "ignored": 3}

    typed = files.rescue(raw.filter("route = 'accepted'").drop("route", "file_path"),
                         {"id": "bigint", "name": "string", "dob": "int", "gender": "string",
                          "country": "string", "email": "string", "file_name": "string"})
    assert typed.filter("_rescued_data is not null").count() == 0
    clean = quality.expect_or_drop(typed.drop("_rescued_data"),
                                   {"gender present": "gender is not null", "dob is a year": "dob is not null"})
    silver = history.two_version_merge(emp_target(spark, SMALL), clean, run_ts="2025-06-01 10:00:00")
    gold_cols = ["id", "name", "dob", "gender", "country", "email", "status", "start_date", "end_date",
                 "file_name", "created_date"]
    gold_table = emp_target(spark, SMALL).filter("status = 'Active'").select(*gold_cols)
    gold = history.publish_masked_snapshot(silver, gold_table, day="2025-06-01")
    assert gold.count() == gold_table.count() + clean.filter("id >= 1000000").count()
    assert gold.filter("email like '%xxx%'").count() > 0
    out = publish.export_single_csv(
        quality.route_by(gold, [("csv", "file_name like 'EmployeeData%'")]).filter("route = 'csv'").drop("route"),
        str(tmp_path / "export"), "export_20250601.csv")
    assert spark.read.option("header", True).csv(out).count() > 0

    # the other route goes to a database table (embedded Derby in memory, no port)
    import uuid

    routed = quality.route_by(gold, [("csv", "file_name like 'EmployeeData%'"),
                                     ("jdbc", "file_name like 'PayrollData%' or file_name like 'BranchData%'")])
    url = f"jdbc:derby:memory:gold{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    to_db = routed.filter("route = 'jdbc'").select("id", "name", "email", "file_name")
    publish.write_jdbc(to_db, url, "GOLD_EXPORT", props, num_partitions=2)
    n_db = to_db.count()
    assert n_db > 0 and spark.read.jdbc(url, "GOLD_EXPORT", properties=props).count() == n_db
