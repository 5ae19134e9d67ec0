"""Text streams with a rescue column and types that widen (S-03, S-04 on streams).

Every micro-batch is written as one load, typed by all data seen so far:

1. the rows are written with the stored types while their sketch
   (:mod:`tidemark.sources.evolve`) is observed, so a load that changes no type
   is read once;
2. if the sketch widens a type, the load is written again with the wider types;
   earlier loads stay as they are;
3. the load's types and the sketch so far are recorded last, in one small file.

Readers see recorded loads only, each read with its own types and cast to the
newest ones; a value rescued under narrower types moves into its column when a
wider type fits it.  Lines with a wrong number of fields keep the values that can
be told and their whole text.  A replayed batch overwrites its own load.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import path_exists
from tidemark.sources import evolve
from tidemark.sources.files import CORRUPT, RESCUE, csv_options
from tidemark.streaming.ingest import run_available
from tidemark.streaming.state import _fs, _read_text, _write_text, observed


class TypedTable:
    """The loads of one text stream under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _loads(self) -> list[int]:
        folder = f"{self.root}/_loads"
        if not path_exists(self.spark, folder):
            return []
        fs, jvm = _fs(self.spark, folder)
        names = [s.getPath().getName() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(folder))]
        return sorted(int(n) for n in names if n.isdigit())

    def record(self, load: int) -> dict:
        return json.loads(_read_text(self.spark, f"{self.root}/_loads/{load}"))

    def before(self, load: int) -> dict:
        """Types, sketch and the loads by types up to the load before ``load``."""
        known = [n for n in self._loads() if n < load]
        return self.record(known[-1]) if known else {"types": None, "sketch": {}, "written": []}

    def schema(self) -> T.StructType | None:
        loads = self._loads()
        return evolve.typed_schema(self.record(loads[-1])["types"], RESCUE) if loads else None

    def write(self, load: int, rows: DataFrame, columns: Sequence[str]) -> None:
        """Record ``rows`` (text columns, and the raw text of broken lines) as a load."""
        last = self.before(load)
        path = f"{self.root}/data/load={load}"
        types, seen = last["types"], None
        if types is not None:
            obs = Observation(f"types-{load}")
            evolve.typed(rows.observe(obs, *evolve.sketch_aggregates(columns)), types, RESCUE, [CORRUPT]).write.mode(
                "overwrite").parquet(path)
            counts = observed(obs)
            seen = evolve.as_sketch(columns, counts) if counts else None
        seen = evolve.merged(last["sketch"], seen if seen is not None else evolve.sketch(rows, columns))
        now = evolve.types_of(seen, types)
        if now != types:
            evolve.typed(rows, now, RESCUE, [CORRUPT]).write.mode("overwrite").parquet(path)
        # runs of loads with equal types: [types, first load, last load]
        written = last["written"]
        if written and written[-1][0] == now:
            written[-1][2] = load
        else:
            written = [*written, [now, load, load]]
        _write_text(self.spark, f"{self.root}/_loads/{load}",
                    json.dumps({"types": now, "sketch": seen, "written": written}))

    def read(self) -> DataFrame:
        """All recorded loads with the newest types."""
        loads = self._loads()
        if not loads:
            raise ValueError(f"no load is recorded under {self.root}")
        last, out = self.record(loads[-1]), None
        for types, first, until in last["written"]:
            paths = [f"{self.root}/data/load={n}" for n in loads if first <= n <= until]
            part = evolve.retyped(self.spark.read.schema(evolve.typed_schema(types, RESCUE)).parquet(*paths),
                                  types, last["types"], RESCUE)
            out = part if out is None else out.unionByName(part)
        return out


def header_names(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """The column names in the header of the files landed so far (reads one line)."""
    return spark.read.options(header="true", sep=sep, inferSchema="false").csv(path).columns


def stream_typed(spark: SparkSession, path: str, root: str, checkpoint: str, *, names: Sequence[str] | None = None,
                 header: bool = True, sep: str = ",", max_files_per_trigger: int | None = None) -> TypedTable:
    """Run the CSV stream at ``path`` over everything that has landed and keep
    it, typed, under ``root``.  ``names`` are the columns; without them those of
    the first run are taken from a header and kept."""
    table = TypedTable(spark, root)
    stored = f"{table.root}/_names"
    if names is None:
        names = json.loads(_read_text(spark, stored)) if path_exists(spark, stored) else header_names(spark, path, sep)
    if not path_exists(spark, stored):
        _write_text(spark, stored, json.dumps(list(names)))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    rows = (spark.readStream.schema(schema).options(**csv_options(header, sep, on_bad_value="null"))
            .option("columnNameOfCorruptRecord", CORRUPT))
    if max_files_per_trigger:
        rows = rows.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def load(batch: DataFrame, batch_id: int) -> None:
        if batch_id not in table._loads():
            table.write(batch_id, batch, list(names))

    run_available(rows.csv(path), checkpoint, sink=load)
    return table
