"""Table contracts (K-01, Q-05): required columns and types as DDL text, stored with
the table and compiled into every write's plan.

The contract is the column list of a ``CREATE TABLE`` (``"id bigint not null, name
string"``).  A write, batch or stream, passes through one projection (columns by
name, cast to the contract's types) and one filter that fails the job on the
first row without a required value.  A failed batch commits no file, so the table
stays as it was.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import expect_or_fail, not_null_rules
from tidemark.session import path_exists
from tidemark.streaming.ingest import append_stream
from tidemark.streaming.state import _read_text, _write_text


class ContractTable:
    """A Parquet table at ``root`` with a stored contract."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    @classmethod
    def create(cls, spark: SparkSession, root: str, ddl: str, *, replace: bool = False) -> ContractTable:
        """The table at ``root``, created with the contract ``ddl`` if it is not
        there (K-01).  A stored contract that differs is an error, unless
        ``replace`` (K-02): then the table starts empty under the new one."""
        schema = T.StructType.fromDDL(ddl)
        place = f"{root.rstrip('/')}/_contract"
        if path_exists(spark, place) and not replace:
            stored = cls.open(spark, root)
            if stored.schema != schema:
                raise ValueError(f"the table at {root} has the contract {stored.schema.simpleString()}")
            return stored
        table = cls(spark, root, schema)
        if replace:
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(table.data)
        _write_text(spark, place, schema.json())
        return table

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> ContractTable:
        return cls(spark, root, T.StructType.fromJson(json.loads(_read_text(spark, f"{root.rstrip('/')}/_contract"))))

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    def checked(self, df: DataFrame) -> DataFrame:
        """``df`` (batch or stream) in the contract's shape; running it fails on
        a row that breaks the contract.  A required column that ``df`` does not
        have, and columns the contract does not know, are errors at once."""
        have = {c.lower(): c for c in df.columns}
        known = {f.name.lower() for f in self.schema.fields}
        missing = [f.name for f in self.schema.fields if not f.nullable and f.name.lower() not in have]
        strange = [c for c in df.columns if c.lower() not in known]
        if missing or strange:
            raise ValueError(f"contract of {self.root}: missing {missing}, unknown {strange}")
        shaped = df.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
                             .cast(f.dataType).alias(f.name) for f in self.schema.fields])
        return expect_or_fail(shaped, not_null_rules(self.schema))

    def append(self, df: DataFrame) -> None:
        """Append a batch; all of it or, if a row breaks the contract, nothing."""
        # job commit moves the files of all tasks at once, at the end
        (self.checked(df).write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "1")
         .parquet(self.data))

    def append_stream(self, stream: DataFrame, checkpoint: str):
        """Append a stream, exactly once per input; a bad micro-batch stops it."""
        return append_stream(self.checked(stream), self.data, checkpoint)

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.data):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.data)
