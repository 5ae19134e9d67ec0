"""Type 1 change data with keyed state (T-05): one stored value per key, updated
where it lies, instead of whole buckets rewritten by every micro-batch.

``transformWithState`` keeps the latest row of each key in the RocksDB state store
under the stream's checkpoint.  A micro-batch touches its own keys only; what it
writes are their new rows and the store's own changelog.  Before the shuffle every
Arrow batch keeps one row per key, so a key that holds a third of the rows sends
one in ten thousand of them to its state.  The current table is read from the
state itself.

Deletes stay as tombstones, so that a late, older change cannot bring a key back.
(Timers could remove them, but a run over what is available now does not end
while timers are pending.)
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.cdc import TOMBSTONE
from tidemark.streaming.ingest import run_available

STATE = "latest"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def newest_of_batches(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key and Arrow batch, the one of greatest order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sorted_rows = pa.Table.from_batches([batch])
            sorted_rows = sorted_rows.take(pc.sort_indices(sorted_rows, sort_keys=[(c, "ascending") for c in order],
                                                           null_placement="at_start"))
            at = sorted_rows.append_column("__at", pa.array(range(len(sorted_rows)), pa.int64()))
            last = at.group_by(keys).aggregate([("__at", "max")])["__at_max"]
            yield from sorted_rows.take(last).to_batches()

    return rows.mapInArrow(run, rows.schema)


class LatestRow(StatefulProcessor):
    """The row of greatest (sequence, tiebreak) of a key; equal ones replace it, as a replay does."""

    def __init__(self, schema: T.StructType, key: list[str], order: list[str]):
        self.schema, self.key, self.order = schema, key, order
        self.values = T.StructType([f for f in schema.fields if f.name not in key])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState(STATE, self.values)

    def _rank(self, row) -> tuple:
        # nulls come first, as in the batch operator's order
        return tuple((row[c] is not None, row[c]) for c in self.order)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = None
        for row in rows:
            if best is None or self._rank(row) >= self._rank(best):
                best = row
        names = self.values.fieldNames()
        if self.latest.exists():
            stored = dict(zip(names, self.latest.get()))
            if self._rank(best) < self._rank(stored):
                return
        self.latest.update(tuple(best[c] for c in names))
        yield Row(**{c: best[c] for c in self.schema.fieldNames()})

    def close(self) -> None:
        pass


def stream_scd1_stateful(stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str], sequence_by: str, *,
                         tiebreak: Sequence[str] = (), columns: Sequence[str] | None = None,
                         delete_when: str | None = None) -> None:
    """Run the stream over everything available now.  Each micro-batch's changed
    rows are also written to ``<root>/changes/batch=<id>`` (overwritten by a
    replay); :func:`current` reads the table.

    A key's row changes when its greatest (``sequence_by``, ``tiebreak``...) is at
    least the stored one.  Of several rows with equal order any may stay, so pass
    a tiebreak where sequences repeat.  Null keys are keys.
    """
    spark, keys, order = stream.sparkSession, list(keys), [sequence_by, *tiebreak]
    cols = list(columns) if columns is not None else [c for c in stream.columns if c not in keys]
    cols += [c for c in order if c not in cols]
    dele = F.coalesce(F.expr(delete_when), F.lit(False)) if delete_when is not None else F.lit(False)
    rows = stream.select(*keys, *cols, dele.alias(TOMBSTONE))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    changed = newest_of_batches(rows, keys, order).groupBy(*keys).transformWithState(
        LatestRow(schema, keys, order), schema, "Update", "None")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root.rstrip('/')}/changes/batch={batch_id}")

    run_available(changed, checkpoint, sink=keep, output_mode="update")


def current(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The table: one row per key, tombstones hidden, read from the state store."""
    state = (spark.read.format("statestore").option("path", checkpoint).option("stateVarName", STATE).load())
    return (state.select("key.*", "value.*").filter(~F.col(TOMBSTONE)).drop(TOMBSTONE))
