"""File sources (S-01 .. S-05, S-10): CSV with explicit schemas, schema
persistence for inferred streams, rescued data, file provenance.

Nothing here lists files on the driver: provenance comes from the scan's
hidden ``_metadata`` column, validity of file names is a column predicate.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import path_exists

RESCUE = "_rescued_data"
CORRUPT = "_corrupt_record"

# Fixed text layouts used when writing/reading CSV so timestamps keep microseconds.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def csv_options(header: bool = True, sep: str = ",", *, multi_line: bool = False,
                on_bad_value: str = "fail") -> dict[str, str]:
    """Reading options that lose nothing silently.

    Timestamps parse in the standard layouts (blank or ``T``, any number of
    fractional digits).  With a header, each file's names are checked against
    the schema, so columns in another order are an error and not swapped
    values.  ``on_bad_value="fail"`` refuses values and lines that do not fit;
    ``"null"`` makes them null (use it with :func:`read_csv_rescued`, which
    keeps the text).  Files with quoted line breaks need ``multi_line``; they
    are read by one task each.
    """
    return {
        "header": str(header).lower(),
        "sep": sep,
        "enforceSchema": str(not header).lower(),
        "multiLine": str(multi_line).lower(),
        "mode": {"fail": "FAILFAST", "null": "PERMISSIVE"}[on_bad_value],
    }


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, *, header: bool = True, sep: str = ",",
             ignore_missing_files: bool = False, multi_line: bool = False, on_bad_value: str = "fail") -> DataFrame:
    """S-01: batch CSV scan, always with an explicit schema (no inference pass).

    ``ignore_missing_files`` (S-05) skips files deleted between listing and
    read; off unless asked for, as the result is then not whole.
    """
    return (
        spark.read.options(**csv_options(header, sep, multi_line=multi_line, on_bad_value=on_bad_value))
        .option("ignoreMissingFiles", str(ignore_missing_files).lower())
        .schema(schema)
        .csv(path)
    )


def csv_write_options(header: bool = True, sep: str = ",") -> dict[str, str]:
    return {"header": str(header).lower(), "sep": sep, "timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_FORMAT}


def without_line_breaks(df: DataFrame) -> DataFrame:
    """The rows, failing on a text with a line break: a line-based reader would see two lines."""
    checked = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(c.rlike("[\r\n]"), F.raise_error(F.lit(f"line break in column {f.name}: write it with "
                                                               "multi_line=True and read it so")).cast("string")).otherwise(c)
        checked.append(c.alias(f.name))
    return df.select(*checked)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite", header: bool = True, multi_line: bool = False) -> None:
    """CSV text; values with line breaks only with ``multi_line`` (quoted, for readers with that option)."""
    (df if multi_line else without_line_breaks(df)).write.mode(mode).options(**csv_write_options(header)).csv(path)


def with_provenance(df: DataFrame, *, path_col: str | None = "file_path", name_col: str | None = "file_name",
                    mtime_col: str | None = None) -> DataFrame:
    """S-10: origin of every row from the scan's ``_metadata`` (full path and
    base name), replacing ``input_file_name()`` and the Python basename UDF."""
    cols = []
    if path_col:
        cols.append(F.col("_metadata.file_path").alias(path_col))
    if name_col:
        cols.append(F.col("_metadata.file_name").alias(name_col))
    if mtime_col:
        cols.append(F.col("_metadata.file_modification_time").alias(mtime_col))
    return df.select("*", *cols)


# ---------------------------------------------------------------- schemas
def infer_schema(spark: SparkSession, path: str, *, fmt: str = "csv", sampling_ratio: float = 1.0,
                 options: Mapping[str, str] | None = None) -> T.StructType:
    """Infer a schema with one batch read of what has landed so far (S-03)."""
    reader = spark.read.format(fmt).option("inferSchema", "true").option("samplingRatio", str(sampling_ratio))
    if fmt == "csv":
        reader = reader.options(**csv_options(on_bad_value="null"))
    if options:
        reader = reader.options(**options)
    return reader.load(path).schema


def save_schema(spark: SparkSession, schema: T.StructType, location: str) -> None:
    """Persist a schema as one JSON text file (written through Spark, so any
    Hadoop file system works)."""
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").text(location)


def load_schema(spark: SparkSession, location: str) -> T.StructType | None:
    if not path_exists(spark, location):
        return None  # not saved yet
    rows = spark.read.text(location).take(1)
    return T.StructType.fromJson(json.loads(rows[0][0])) if rows else None


def stream_schema(spark: SparkSession, path: str, location: str, **kw) -> T.StructType:
    """S-03: the schema saved at ``location``, inferring and saving it on first use.

    Spark refuses a file stream without a schema; this makes the first run
    infer it once and every restart reuse the same one.
    """
    schema = load_schema(spark, location)
    if schema is None:
        schema = infer_schema(spark, path, **kw)
        save_schema(spark, schema, location)
    return schema


# ---------------------------------------------------------------- rescue
def rescue(df: DataFrame, schema: T.StructType | Mapping[str, str], *, column: str = RESCUE) -> DataFrame:
    """S-04: typed columns plus ``_rescued_data``.

    ``df`` holds text columns (CSV read with all strings).  Each column of
    ``schema`` is ``try_cast``; a value that is present but does not fit
    becomes null and is kept, by column name, in a JSON object in
    ``_rescued_data`` (null when the row is clean).  Columns of ``df`` that the
    schema does not know are rescued too.
    """
    if isinstance(schema, T.StructType):
        types = {f.name: f.dataType.simpleString() for f in schema.fields}
    else:
        types = dict(schema)
    # column names match case-insensitively, as Spark resolves them
    have = {c.lower(): c for c in df.columns}
    src = {c: have.get(c.lower()) for c in types}
    typed = [F.col(src[c]).try_cast(t).alias(c) if src[c] else F.lit(None).cast(t).alias(c)
             for c, t in types.items()]
    bad = []
    for c, t in types.items():
        if src[c]:
            v = F.col(src[c])
            bad += [F.lit(c), F.when(v.isNotNull() & v.try_cast(t).isNull(), v.cast("string"))]
    known = {s.lower() for s in src.values() if s}
    for c in df.columns:
        if c.lower() not in known and c != column:
            bad += [F.lit(c), F.col(c).cast("string")]
    if bad:
        m = F.map_filter(F.create_map(*bad), lambda k, v: v.isNotNull())
        rescued = F.when(F.size(m) > 0, F.to_json(m))
    else:
        rescued = F.lit(None).cast("string")
    return df.select(*typed, rescued.alias(column))


def string_schema(schema: T.StructType) -> T.StructType:
    """The same field names, all text (how a CSV arrives before typing)."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def rescued_clean(column: str = RESCUE) -> Column:
    """The reference's gold rule: no rescued data."""
    return F.col(column).isNull()


def read_csv_rescued(spark: SparkSession, path: str, schema: T.StructType | Mapping[str, str], *,
                     header: bool = True, sep: str = ",", column: str = RESCUE) -> DataFrame:
    """S-04 end to end: typed columns plus ``_rescued_data`` for values that
    do not fit *and* for lines with too many or too few fields (their raw text
    is kept under ``_corrupt_record``, from Spark's PERMISSIVE parser)."""
    types = {f.name: f.dataType.simpleString() for f in schema.fields} if isinstance(schema, T.StructType) \
        else dict(schema)
    text_schema = T.StructType([T.StructField(c, T.StringType(), True) for c in types]
                               + [T.StructField(CORRUPT, T.StringType(), True)])
    raw = (spark.read.options(**csv_options(header, sep, on_bad_value="null")).option("columnNameOfCorruptRecord", CORRUPT)
           .schema(text_schema).csv(path))
    # ``_corrupt_record`` is not a schema column, so rescue() files the raw
    # line under that name -- and only for broken lines, where it is set
    return rescue(raw, types, column=column)
