"""Session and scratch-space helpers.

Everything that writes intermediate data (tables, stream checkpoints, model
directories) goes under one *shared* folder.  On a cluster that folder is the
one the cluster names in ``spark.checkpoint.dir``; we only invent one (under the
local temp dir) when the session has none, which is the case in tests.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # pinned (checkpointed) inputs are deleted once no plan references them,
    # so multi-pass operators do not leave copies of their input behind
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app: str = "churnlane", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("CHURNLANE_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Pin settings that results depend on (time zone for timestamp_ntz math)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared scratch root (``spark.checkpoint.dir``).

    Read from the session; only when it is unset (local tests) create one and
    register it, so ``DataFrame.checkpoint()`` and our own tables agree.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext handle (remote session): conf only
        sc = None
    d = sc.getCheckpointDir() if sc is not None else None
    if d:
        return d.rstrip("/")
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="churnlane-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared scratch root."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    """A fresh table name; every call of a query uses its own tables."""
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


MB = 1024 * 1024


def cluster_conf(input_bytes: int, executors: int = 1000, cores_per_executor: int = 4,
                 target_partition_bytes: int = 256 * MB, shuffle_fraction: float = 0.25,
                 max_map_tasks: int = 200_000, max_shuffle_partitions: int = 100_000
                 ) -> dict[str, str]:
    """Settings for a large cluster, derived from the input size.

    * Input splits (``maxPartitionBytes``) are 128 MB until that would mean
      more than ``max_map_tasks`` scan tasks, then grow (up to 1 GB): at
      100 TB, ~200k tasks of 512 MB instead of ~800k of 128 MB.
    * Shuffle partitions are sized from the bytes expected to be *shuffled*
      (``shuffle_fraction`` of the input — our plans aggregate map-side and
      prune columns before every exchange), ``target_partition_bytes`` each,
      never fewer than the task slots and at most ``max_shuffle_partitions``;
      AQE then coalesces small ones at run time.  Sizing reducers from the
      raw input would give ~400k partitions at 100 TB, i.e. 10^11 shuffle
      blocks with 800k map tasks.
    * Skew handling stays on; broadcasts stay behind Spark's measured-size
      thresholds; pinned checkpoints are cleaned once unreferenced.
    """
    slots = executors * cores_per_executor
    split = 128 * MB
    if -(-input_bytes // split) > max_map_tasks:
        split = min(1024 * MB, -(-input_bytes // max_map_tasks))
        split = -(-split // MB) * MB                   # whole megabytes
    shuffle_bytes = int(input_bytes * shuffle_fraction)
    parts = max(slots, min(max_shuffle_partitions, -(-shuffle_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def default_buckets(spark: SparkSession) -> int:
    """Bucket / range count for key-level tables (feature tables, snapshots)
    and per-feature value ranges: the shuffle partition count, which is sized
    from the input (``cluster_conf``).  Pass an explicit count where a table
    is far smaller than that.
    """
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))


def pin(df):
    """Materialise ``df`` once with a reliable ``checkpoint()`` in the shared
    checkpoint dir and cut its lineage.

    For plans consumed by several jobs (multi-pass operators, train + test
    sides of one prepared frame): the upstream — typically a large
    aggregation — runs once, and a lost executor re-reads checkpoint files
    instead of recomputing the whole lineage.  Never ``localCheckpoint``.
    With ``spark.cleaner.referenceTracking.cleanCheckpoints`` (set by
    ``get_session`` / ``cluster_conf``) the files are removed once the pinned
    frame is no longer referenced.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df, name: str):
    """(frame, path): ``df`` written to a new Parquet folder below the shared scratch root and read back.

    Like ``pin``, but compressed, read by column, and of a size the planner
    knows: for loops whose rounds each join the round before (estimates of a
    pinned plan multiply).  The caller removes the path once nothing reads it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def ship() -> None:
    """Pickle this package's functions and classes by value, so Python workers need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules["churnlane"])
