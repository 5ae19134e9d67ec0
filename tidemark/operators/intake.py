"""Routed writes with an outcome (K-13, Q-07): one pass writes every route to its
own place and counts it, and a gate decides before anything becomes visible.

1. the rows are written once, partitioned by route, to a pending folder, while
   an observation counts them; the counts are kept beside them;
2. the gate looks at the counts: a run without accepted rows stops here and
   changes nothing (its rows stay pending, to be looked at);
3. the route folders move to ``<root>/<route>/run=<id>`` by rename;
4. the run's marker, with the counts, is written last.  Readers see marked runs.

A run that is repeated after a crash goes on where it stopped; one that is marked
is skipped.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import path_exists
from tidemark.streaming.state import _fs, _read_text, _write_text, observed


class NothingAccepted(RuntimeError):
    """The gate of a run was not passed; ``counts`` says what came in."""

    def __init__(self, run: str, counts: dict[str, int]):
        super().__init__(f"run {run} stops, nothing was accepted: {counts}")
        self.counts = counts


def some_accepted(counts: dict[str, int]) -> bool:
    """The usual gate: at least one row of the route ``accepted``."""
    return counts.get("accepted", 0) > 0


class Intake:
    """The routes of one intake under ``root``; ``routes`` names them all."""

    def __init__(self, root: str, routes: Sequence[str] = ("accepted", "rejected", "ignored"), route_col: str = "route",
                 gate: Callable[[dict[str, int]], bool] = some_accepted):
        self.root, self.routes, self.route_col, self.gate = root.rstrip("/"), list(routes), route_col, gate

    def outcome(self, spark: SparkSession, run: str) -> dict[str, int] | None:
        """Rows by route of a finished run."""
        marker = f"{self.root}/_runs/{run}"
        return json.loads(_read_text(spark, marker)) if path_exists(spark, marker) else None

    def write(self, rows: DataFrame, run: str) -> dict[str, int]:
        """Write ``rows`` (with the route column; a row of no known route fails
        the job) as run ``run``; the counts by route."""
        spark = rows.sparkSession
        done = self.outcome(spark, run)
        if done is not None:
            return done
        pending = f"{self.root}/_pending/{run}"
        if not path_exists(spark, f"{pending}/_COUNTS"):
            obs = Observation(f"intake-{run}")
            route = F.col(self.route_col)
            known = F.when(F.coalesce(route.isin(self.routes), F.lit(False)), True).otherwise(
                F.raise_error(F.concat(F.lit("no such route: "), F.coalesce(route, F.lit("null")))).cast("boolean"))
            counted = rows.filter(known).observe(obs, *[F.count_if(route == r).alias(r) for r in self.routes])
            counted.withColumn("__route", route).write.mode("overwrite").partitionBy("__route").parquet(f"{pending}/rows")
            seen = observed(obs)
            _write_text(spark, f"{pending}/_COUNTS", json.dumps({r: int(seen.get(r) or 0) for r in self.routes}))
        counts = json.loads(_read_text(spark, f"{pending}/_COUNTS"))
        if not self.gate(counts):
            raise NothingAccepted(run, counts)
        fs, jvm = _fs(spark, self.root)
        path = jvm.org.apache.hadoop.fs.Path
        for r in self.routes:
            source, dest = path(f"{pending}/rows/__route={r}"), path(f"{self.root}/{r}/run={run}")
            if fs.exists(source):  # else it is empty, or moved already
                fs.mkdirs(dest.getParent())
                if not fs.rename(source, dest):
                    raise RuntimeError(f"could not move {source} to {dest}")
        _write_text(spark, f"{self.root}/_runs/{run}", json.dumps(counts))
        fs.delete(path(pending), True)
        return counts

    def read(self, spark: SparkSession, route: str, schema: T.StructType) -> DataFrame:
        """The rows of one route in all finished runs, with ``run``."""
        fs, jvm = _fs(spark, self.root)
        path = jvm.org.apache.hadoop.fs.Path
        marks = path(f"{self.root}/_runs")
        runs = [s.getPath().getName() for s in fs.listStatus(marks)] if fs.exists(marks) else []
        base = f"{self.root}/{route}"
        folders = [f"{base}/run={r}" for r in runs if not r.startswith(".") and fs.exists(path(f"{base}/run={r}"))]
        full = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
        if not folders:
            return spark.createDataFrame([], full)
        return spark.read.schema(full).option("basePath", base).parquet(*folders)
