"""SURVEY rows served by Spark built-ins (S-06..S-08, K-01..K-03, K-05, K-10, K-14), exercised once."""

from __future__ import annotations

import uuid

from pyspark.sql import types as T

from tidemark.operators import quality


def test_ddl_insert_ctas_exists_and_views(spark, tmp_path):
    db = f"tm_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {db} LOCATION '{tmp_path}/db'")
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {db}.employee (id INT NOT NULL, name STRING NOT NULL, dob INT,
                  file_name STRING, datetimestamp TIMESTAMP) USING parquet LOCATION '{tmp_path}/employee'""")
    assert spark.catalog.tableExists(f"{db}.employee")
    spark.sql(f"INSERT INTO {db}.employee VALUES (1, 'a', 1990, 'f.csv', TIMESTAMP'2024-01-01 00:00:00')")
    spark.sql(f"CREATE TABLE {db}.copy USING parquet LOCATION '{tmp_path}/copy' AS SELECT * FROM {db}.employee")
    assert spark.table(f"{db}.copy").count() == 1
    spark.table(f"{db}.employee").createOrReplaceTempView("emp_view")
    assert spark.sql("SELECT count(*) FROM emp_view").first()[0] == 1
    # NOT NULL columns become rules (Q-05) instead of trusting the storage layer
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("dob", T.IntegerType())])
    assert list(quality.not_null_rules(schema)) == ["id is not null"]
    spark.sql(f"DROP TABLE IF EXISTS {db}.copy")
    assert not spark.catalog.tableExists(f"{db}.copy")
    spark.sql(f"DROP SCHEMA {db} CASCADE")


def test_external_csv_table_and_query_by_path(spark, tmp_path):
    p = str(tmp_path / "csv")
    spark.createDataFrame([("F", "IN"), ("M", "IN"), ("F", "US")], "gender string, country string") \
        .write.option("header", True).csv(p)
    name = f"ext_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {name} (gender STRING, country STRING) USING csv OPTIONS (path '{p}', header 'true')")
    got = {(r.gender, r.country): r.n for r in spark.sql(
        f"SELECT gender, country, count(*) AS n FROM {name} GROUP BY gender, country").collect()}
    assert got == {("F", "IN"): 1, ("M", "IN"): 1, ("F", "US"): 1}
    # by path there are no options: every file's header comes back as a row
    assert spark.sql(f"SELECT count(*) FROM csv.`{p}` WHERE _c0 <> 'gender'").first()[0] == 3
    spark.sql(f"DROP TABLE {name}")


def test_inline_rows_and_range(spark):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    assert spark.createDataFrame([(1, "a")], schema).count() == 1
    assert spark.createDataFrame([(1, "a")], "id int, name string").columns == ["id", "name"]
    assert spark.range(1).count() == 1


def test_replace_table_and_read_table_as_stream(spark, tmp_path):
    """K-02 (create or replace = overwrite saveAsTable) and S-09 (a table read
    statically and as a stream)."""
    name = f"rep_{uuid.uuid4().hex[:8]}"
    spark.range(3).write.mode("overwrite").option("path", str(tmp_path / "rep")).saveAsTable(name)
    spark.range(5).write.mode("overwrite").option("path", str(tmp_path / "rep")).saveAsTable(name)
    assert spark.table(name).count() == 5
    q = (spark.readStream.table(name).writeStream.format("parquet")
         .option("path", str(tmp_path / "copy")).option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 5
    spark.sql(f"DROP TABLE {name}")
