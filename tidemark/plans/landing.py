"""Landing zone built from the driver's tables, for the file and stream queries.

``events`` is written as CSV into a fresh folder under the shared checkpoint
root, in three appends out of sequence order (``event_id % 3`` = 2, 0, 1), the
way files from several senders arrive.  Every call gets its own folder.
A sender's files follow its rows (about ``FILE_ROWS`` each), not the tasks that
read them: a stream that takes a file at a time would otherwise have the more
micro-batches, each rewriting its buckets, the finer a session splits its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.fixtures import table
from tidemark.session import scratch_path
from tidemark.sources.files import write_csv

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
ARRIVAL_ORDER = (2, 0, 1)
FILE_ROWS = 1 << 20


def land(df: DataFrame, root: str, *, by_folder: bool = False) -> str:
    """Write ``df`` in three appends; ``by_folder`` puts each in its own sub-folder."""
    n_files = max(1, -(-df.count() // (len(ARRIVAL_ORDER) * FILE_ROWS)))
    for k in ARRIVAL_ORDER:
        part = df.filter(F.col("event_id").cast("long") % 3 == k).coalesce(n_files)
        dest = f"{root}/landing/batch_{k}" if by_folder else f"{root}/landing"
        write_csv(part, dest, mode="append")
    return f"{root}/landing"


def land_events(spark: SparkSession, sf: str, name: str, *, by_folder: bool = False,
                events: DataFrame | None = None) -> tuple[str, str]:
    """Returns (scratch root, landing folder)."""
    root = scratch_path(spark, name)
    ev = events if events is not None else table(spark, sf, "events").select(*EVENT_COLS)
    return root, land(ev, root, by_folder=by_folder)
