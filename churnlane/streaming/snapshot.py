"""Keep a newest-row-per-key snapshot current from a stream (STR-2, SNK-6).

Layout under ``root``:

* ``changes/batch=<id>/`` — what micro-batch ``id`` brought: its own newest
  row per key (``latest_per_key`` of the batch alone).  Cost O(batch), not
  O(keys): a micro-batch never rewrites the snapshot.
* ``v=<id>/`` — a full copy (the reference's "full copy" sync mode), folded
  every ``compact_every`` batches from the previous full copy and the change
  sets after it, hash-partitioned by the key and sorted within files.

The current snapshot is the newest full copy whose write committed
(``_SUCCESS``) merged with the committed change sets after it, by the same
newest-wins aggregation (``max_by`` — partial, map-side).  A reader that
filters on the key gets the filter pushed below that aggregation into both
scans.  At most ``compact_every - 1`` change sets are ever merged on read.

Replay safety: a re-run of batch ``k`` (same id, same input files — the
stream checkpoint pins both) overwrites ``changes/batch=k`` with the same
rows, and a fold at ``k`` reads only full copies older than ``k`` and change
sets up to ``k``, so it rewrites ``v=k`` identically.  Newest-wins merging
is idempotent and late rows lose by timestamp, so overlapping inputs never
change the result.  Nothing that a reader may be reading is overwritten
except by identical data.

``retain`` full copies are kept after a fold, and the change sets after the
oldest of them; what is older is removed, so a reader has ``retain - 1`` folds
of time for a scan it has begun.

Where the file system cannot be listed (no JVM gateway), a small
``_current`` file records the newest full copy and batch instead.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from churnlane.operators.latest import latest_per_key
from churnlane.session import default_buckets
from churnlane.sources import control

_V = r"v=(\d+)"
_CH = r"batch=(\d+)"


def _state(spark: SparkSession, root: str) -> tuple[int | None, list[int]]:
    """(newest committed full copy, committed change sets after it)."""
    versions = control.list_numbered(spark, root, _V, "_SUCCESS")
    if versions is not None:
        base = versions[-1] if versions else None
        changes = control.list_numbered(spark, f"{root}/changes", _CH, "_SUCCESS") or []
        return base, [c for c in changes if base is None or c > base]
    text = control.read_text(spark, f"{root}/_current")
    if not text:
        return None, []
    st = json.loads(text)
    base, last = st.get("base"), st["last"]
    return base, list(range(0 if base is None else base + 1, last + 1))


def _merged(spark: SparkSession, root: str, base: int | None, changes: Sequence[int],
            key: Sequence[str] | str, ts: str, tie: Sequence[str] | str) -> DataFrame | None:
    paths = [f"{root}/changes/batch={c}" for c in changes]
    if base is not None:
        if not paths:
            return spark.read.parquet(f"{root}/v={base}")   # a full copy is key-unique already
        paths.insert(0, f"{root}/v={base}")
    if not paths:
        return None
    return latest_per_key(spark.read.parquet(*paths), key, ts, tie)


def current_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """The snapshot as of the newest committed batch (None before the first).

    The merge spec (key, timeseries key, tie-breaks) is the one the stream
    recorded in ``root/_spec``."""
    spec = control.read_text(spark, f"{root}/_spec")
    if spec is None:
        return None
    sp = json.loads(spec)
    base, changes = _state(spark, root)
    return _merged(spark, root, base, changes, sp["key"], sp["ts"], sp["tie"])


def fold(spark: SparkSession, root: str, upto: int, key: Sequence[str] | str, ts: str,
         tie: Sequence[str] | str = (), buckets: int | None = None) -> None:
    """Write the full copy ``v=<upto>``: the newest full copy older than
    ``upto`` merged with the change sets after it up to ``upto``."""
    n = buckets or default_buckets(spark)
    versions = control.list_numbered(spark, root, _V, "_SUCCESS")
    if versions is None:                               # no listing: follow the pointer
        base, _ = _state(spark, root)
        base = base if base is not None and base < upto else None
    else:
        older = [v for v in versions if v < upto]
        base = older[-1] if older else None
    changes = list(range(0 if base is None else base + 1, upto + 1))
    merged = _merged(spark, root, base, changes, key, ts, tie)
    if merged is None:
        return
    # hash-partitioned by the key (files hold disjoint key sets), sorted for
    # tight row-group statistics on key lookups
    keys = [key] if isinstance(key, str) else list(key)
    (merged.repartition(n, *keys).sortWithinPartitions(*keys)
           .write.mode("overwrite").parquet(f"{root}/v={upto}"))


def expire(spark: SparkSession, root: str, retain: int) -> None:
    """Remove full copies before the newest ``retain``, and the change sets that these contain."""
    kept = (control.list_numbered(spark, root, _V, "_SUCCESS") or [])[-retain:]
    if len(kept) < retain:
        return
    for v in control.list_numbered(spark, root, _V) or []:
        if v < kept[0]:
            control.delete(spark, f"{root}/v={v}")
    for c in control.list_numbered(spark, f"{root}/changes", _CH) or []:
        if c <= kept[0]:
            control.delete(spark, f"{root}/changes/batch={c}")


def maintain_latest(spark: SparkSession, events_path: str, schema: StructType | str, root: str,
                    checkpoint: str, key: Sequence[str] | str, ts: str, tie: Sequence[str] | str = (),
                    max_files_per_trigger: int | None = None, buckets: int | None = None,
                    trigger: dict | None = None, wait: bool = True, compact_every: int = 8,
                    retain: int = 2):
    """Start the snapshot-maintenance stream (see module doc); returns the query."""
    if compact_every < 1 or retain < 2:
        raise ValueError("compact_every must be at least 1 and retain at least 2")
    key = [key] if isinstance(key, str) else list(key)
    ties = [tie] if isinstance(tie, str) else list(tie)
    control.write_text(spark, f"{root}/_spec", json.dumps({"key": key, "ts": ts, "tie": ties}))
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:                  # bounded micro-batches; default: all new files
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(events_path)

    def merge(batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch, key, ts, ties).write.mode("overwrite") \
            .parquet(f"{root}/changes/batch={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            fold(spark, root, batch_id, key, ts, ties, buckets)
            expire(spark, root, retain)
            base = batch_id
        else:
            prev = control.read_text(spark, f"{root}/_current")
            base = json.loads(prev).get("base") if prev else None
        # mirror for sessions that cannot list; listing readers ignore it
        control.write_text(spark, f"{root}/_current", json.dumps({"base": base, "last": batch_id}))

    q = (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})).start())
    if wait:
        q.awaitTermination()
    return q
