"""Expectation metrics of streams, kept (Q-01 .. Q-03).

``quality.expect(stream, rules, observation=name)`` counts failures in every
micro-batch, but the counts live in the query's progress and go with it.  A
listener turns them into rows, one per micro-batch and rule, in files named by
query id and batch id.  The query id is kept in the checkpoint, so a restarted
stream goes on in the same log and a repeated batch overwrites its own file.
"""

from __future__ import annotations

import json
import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.streaming.state import _write_text

LOG_SCHEMA = ("query_id string, query_name string, observation string, batch_id long, timestamp string, rule string, "
              "n_rows long, n_failed long")
_FAILED = "failed:"


class ExpectationLog(StreamingQueryListener):
    """Writes the observed rule counts of all streams of a session under ``root``."""

    def __init__(self, spark: SparkSession, root: str, settle_seconds: float = 60):
        self.spark, self.root, self.settle_seconds = spark, root.rstrip("/"), settle_seconds
        self.open: set[str] = set()
        self.quiet = threading.Condition()
        self.errors: list[Exception] = []

    def onQueryStarted(self, event) -> None:
        with self.quiet:
            self.open.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        try:
            for name, counts in (p.observedMetrics or {}).items():
                counts = counts.asDict()
                rows = [{"query_id": str(p.id), "query_name": p.name, "observation": name, "batch_id": p.batchId,
                         "timestamp": p.timestamp, "rule": k[len(_FAILED):], "n_rows": counts.get("rows"), "n_failed": v}
                        for k, v in counts.items() if k.startswith(_FAILED)]
                if rows:
                    _write_text(self.spark, f"{self.root}/{p.id}-{name}-{p.batchId:012d}.json",
                                "".join(json.dumps(r) + "\n" for r in rows))
        except Exception as e:  # noqa: BLE001 - raised to the caller when the log is closed
            self.errors.append(e)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.quiet:
            self.open.discard(str(event.runId))
            self.quiet.notify_all()

    def settle(self) -> None:
        """Wait for the events of ended queries, which arrive after the queries end."""
        with self.quiet:
            if not self.quiet.wait_for(lambda: not self.open, timeout=self.settle_seconds):
                raise TimeoutError("streams of this log are still running")
        if self.errors:
            raise self.errors[0]


@contextmanager
def keep_expectations(spark: SparkSession, root: str):
    """Streams started inside the block have their expectation counts kept under
    ``root``; the block ends when the counts of its ended streams are written."""
    log = ExpectationLog(spark, root)
    spark.streams.addListener(log)
    try:
        yield log
        log.settle()
    finally:
        spark.streams.removeListener(log)


def read_expectations(spark: SparkSession, root: str) -> DataFrame:
    """One row per query, micro-batch and rule."""
    return spark.read.schema(LOG_SCHEMA).json(f"{root.rstrip('/')}/*.json").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp"))
