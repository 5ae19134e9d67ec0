"""Session helpers: a sane local session for tests and a shared scratch area.

On a cluster the scratch area is the folder named by ``spark.checkpoint.dir``
(a shared file system path every executor can reach).  Only when that is unset
-- local tests, the smoke check -- do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in _DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "16g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Read from the session (``spark.checkpoint.dir`` conf or the context's
    checkpoint dir); only a local master, where one process does all, gets a
    private one when none is named.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
            root = jdir.get() if jdir.isDefined() else None
        except Exception:  # noqa: BLE001 - no JVM context (remote session): the conf is all there is
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        for setter in (lambda: spark.sparkContext.setCheckpointDir(root),
                       lambda: spark.conf.set("spark.checkpoint.dir", root)):
            try:
                setter()
            except Exception:  # noqa: BLE001 - either record is enough to find it again
                pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tidemark-scratch/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint root and read
    it back.

    Cuts the lineage (a lost executor recomputes from the staged files, not
    from the whole input) and gives the planner the *real* size of the data:
    a join against it is broadcast only when the written files are under
    ``spark.sql.autoBroadcastJoinThreshold``, otherwise it is shuffled.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def cluster_conf(input_bytes: int, total_cores: int, *, target_partition_bytes: int = 256 << 20,
                 checkpoint_dir: str | None = None) -> dict[str, str]:
    """Settings for a large cluster, sized from the input volume.

    Shuffle partitions: enough that each holds about ``target_partition_bytes``
    and at least three waves of tasks; AQE coalesces small ones and splits
    skewed join partitions at run time.  Scan splits use the same target size.
    ``checkpoint_dir`` must be a shared file system path (lineage cuts, staged
    merge sources, stream state).
    """
    partitions = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # bucketed writes REBALANCE by bucket: let AQE split a hot bucket
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
    }
    if checkpoint_dir:
        conf["spark.checkpoint.dir"] = checkpoint_dir
    return conf


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path`` (no query)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def scratch_to_clear(spark: SparkSession, older_than_hours: float, root: str | None = None) -> list[str]:
    """Folders under ``<root>/tidemark-scratch`` (root: the shared checkpoint
    folder) last modified more than ``older_than_hours`` ago.  Staged inputs
    are read lazily by the DataFrames built on them, so choose an age beyond
    the longest job that may still use them."""
    import time

    base = f"{(root or checkpoint_root(spark)).rstrip('/')}/tidemark-scratch"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    cutoff_ms = (time.time() - older_than_hours * 3600) * 1000
    return sorted(st.getPath().toString() for st in fs.listStatus(p)
                  if st.isDirectory() and st.getModificationTime() < cutoff_ms)


def clear_scratch(spark: SparkSession, older_than_hours: float, root: str | None = None) -> list[str]:
    """Delete the folders ``scratch_to_clear`` names; returns them."""
    gone = scratch_to_clear(spark, older_than_hours, root)
    jvm = spark.sparkContext._jvm
    for path in gone:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return gone
