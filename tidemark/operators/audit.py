"""Commit log, merge audit and table profile (O-07, A-05, P-10, P-16, A-03, J-04).

Our merges report their counts through an :class:`Observation`; ``commit_log``
turns those into the history row shape (operation, timestamp, user, a
``map<string,string>`` of metrics).  ``metrics_pivot`` and ``merge_audit``
rebuild the audit flow on that log: keep chosen operations, explode the map,
pivot with *listed* metric names (no extra distinct job, fixed schema, missing
metrics become 0), join back to the commit info, upsert into the audit table
keyed by operation where the latest commit wins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import upsert_mapped

# The metric names of a merge commit and the operations audited.
MERGE_METRICS = ("numTargetRowsInserted", "numTargetRowsUpdated", "numTargetRowsDeleted")
AUDITED_OPERATIONS = ("MERGE", "WRITE")

COMMIT_SCHEMA = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("operation_metrics", T.MapType(T.StringType(), T.StringType())),
])

#: names of a merge's observed counts in a commit
METRIC_NAMES = {"num_inserted": "numTargetRowsInserted", "num_updated": "numTargetRowsUpdated",
                  "num_deleted": "numTargetRowsDeleted", "num_copied": "numTargetRowsCopied"}


def commit_log(spark: SparkSession, version: str, operation: str, metrics: Observation | Mapping[str, int],
               *, ts=None, user: str | None = None) -> DataFrame:
    """One commit row from a merge's observed metrics (read after the write)."""
    import datetime as _dt

    values = metrics.get if isinstance(metrics, Observation) else metrics
    m = {METRIC_NAMES.get(k, k): str(v) for k, v in dict(values).items()}
    row = (version, operation, ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), user, m)
    return spark.createDataFrame([row], COMMIT_SCHEMA)


def metrics_pivot(commits: DataFrame, *, operations: Sequence[str] = AUDITED_OPERATIONS,
                  metrics: Sequence[str] = MERGE_METRICS, id_col: str = "version", missing: int | None = 0) -> DataFrame:
    """The listed metrics of each commit as columns (sum of int values) with
    the commit info: one scan, one aggregate by commit id.  Commits without any
    metric are left out.  A metric that a commit does not report becomes
    ``missing``: 0 as in the audit flow, or ``None`` where not measured and none
    at all must be told apart, as in logs of real commits."""
    kept = commits.filter(F.col("operation").isin(list(operations)) & (F.size("operation_metrics") > 0))
    values = [F.coalesce(F.sum(F.try_element_at("operation_metrics", F.lit(m)).try_cast("bigint")),
                         F.lit(missing).cast("bigint")).alias(m) for m in metrics]
    info = F.collect_list(F.struct("operation", "timestamp", "user_name")).alias("info")
    return kept.groupBy(id_col).agg(*values, info).select(id_col, *metrics, F.inline("info"))


def merge_audit(audit: DataFrame, pivoted: DataFrame, *, notebook_name: str | Column,
                metrics: Sequence[str] = MERGE_METRICS) -> DataFrame:
    """Upsert the pivoted metrics into the audit table keyed by operation; when
    several commits of one operation arrive, the latest timestamp wins."""
    nb = notebook_name if isinstance(notebook_name, Column) else F.lit(notebook_name)
    src = pivoted.withColumn("notebook_name", nb)
    sets = {"update_time": "s.timestamp", "user_name": "s.user_name", "notebook_name": "s.notebook_name",
            **{m: f"s.{m}" for m in metrics}}
    return upsert_mapped(audit, src, ["operation"], update_set=sets,
                         insert_values={"operation": "s.operation", **sets},
                         on_duplicates="latest", sequence_by=["timestamp", "version"])


# ---------------------------------------------------------------- profile
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def profile(df: DataFrame, *, approx: bool = True, quantiles: Sequence[float] = (0.25, 0.5, 0.75),
            rounding: int | None = None) -> DataFrame:
    """A-05: one output row per column, by an aggregate pass over the string
    columns and one over all others.

    Exact: rows, nulls, min, max (as text), mean and standard deviation of
    numeric columns.  With ``approx``: distinct count (HyperLogLog++) and
    quantiles (``percentile_approx``), both mergeable partial aggregates, so
    the pass never gathers a column in one task.
    """
    def rows_of(fields: list[T.StructField]) -> DataFrame:
        aggs: list[Column] = [F.count(F.lit(1)).alias("__n")]
        rows = []
        for i, f in enumerate(fields):
            c = F.col(f"`{f.name}`")
            num = isinstance(f.dataType, _NUMERIC)
            mean = F.avg(c) if num else F.lit(None).cast("double")
            sd = F.stddev_samp(c) if num else F.lit(None).cast("double")
            if rounding is not None:
                mean, sd = F.round(mean, rounding), F.round(sd, rounding)
            aggs += [F.count_if(c.isNull()).alias(f"n{i}"), F.min(c).cast("string").alias(f"lo{i}"),
                     F.max(c).cast("string").alias(f"hi{i}"), mean.alias(f"m{i}"), sd.alias(f"s{i}")]
            parts = [F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.col("__n").alias("n_rows"), F.col(f"n{i}").alias("n_nulls"),
                     F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"),
                     F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev")]
            if approx:
                quantile = F.percentile_approx(c.cast("double"), list(quantiles)) if num else F.lit(None).cast("array<double>")
                aggs += [F.approx_count_distinct(c).alias(f"d{i}"), quantile.alias(f"q{i}")]
                parts += [F.col(f"d{i}").alias("approx_distinct"), F.col(f"q{i}").alias("approx_quantiles")]
            rows.append(F.struct(*parts))
        return df.agg(*aggs).select(F.inline(F.array(*rows)))

    # the smallest and largest strings need a sort-based aggregate; a pass of their own
    # leaves all other columns in a hash aggregate, and each pass reads its columns only
    text = [f for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    other = [f for f in df.schema.fields if not isinstance(f.dataType, T.StringType)]
    parts = [rows_of(fields) for fields in (other, text) if fields]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
