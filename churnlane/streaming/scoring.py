"""Streaming request scoring with a request log (STR-1, STR-3).

``readStream`` of request files -> key coercion -> ``foreachBatch``: LEFT
join of the micro-batch with the feature snapshot -> native tree expression
-> one write of the scored rows, which carry the raw request as JSON and an id
of its own.  The request log is a projection of those rows (``request_log``),
so a micro-batch is read, joined, scored and written once.  Each micro-batch
overwrites its own ``batch=<id>`` directory: a batch replayed after a failure
(same id, same input files — the checkpoint pins both) rewrites the same files
instead of appending duplicates.  Stateless, unless requests carry a client's id
by which those sent again are dropped.

``snapshot`` may be a function: it is called for every micro-batch, so a
long-running stream follows snapshot refreshes.  Requests that carry every
feature themselves are conformed to the contract and need no snapshot.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnlane.operators.contract import Contract, conform
from churnlane.operators.features import coerce_key, join_hot_split, key_list, keys_in_scan
from churnlane.operators.tree import predict
from churnlane.sources.sinks import sent


def score_stream(spark: SparkSession, requests_path: str, request_schema: StructType | str,
                 snapshot: DataFrame | Callable[[], DataFrame] | None, contract: Contract, key: str | Sequence[str],
                 out_path: str, checkpoint: str, served_model: str, max_files_per_trigger: int | None = None,
                 keep: Sequence[str] = (), trigger: dict | None = None, wait: bool = True,
                 skew_fraction: float | None = None, client_id: str | None = None, sent_at: str | None = None,
                 resent_within: str = "1 hour", push_keys: int = 0):
    """Start the scoring stream.

    The streaming plan only reads requests; the lookup join runs inside
    ``foreachBatch`` on the micro-batch, where it is an ordinary batch plan:
    AQE re-plans it from measured sizes (broadcast, or sort-merge with
    skewed request partitions split).  ``skew_fraction`` additionally splits
    request keys holding more than that share of a micro-batch off to a
    bounded broadcast (``join_hot_split``).  ``push_keys``: a micro-batch with at most
    so many distinct keys reads only the parts of the snapshot that may hold them.

    Output columns: request_id (unique: batch and row), request (JSON of the
    request as it came), request_key (text; JSON for a key of several columns), the key
    columns, the features, prediction, served_model and ``keep``.  A key that is no key and a value that is no
    number become NULL there and stay readable in ``request``.

    ``client_id`` names the column with the client's own id of a request, ``sent_at`` its
    time: a request sent again, in this or a later micro-batch, at most ``resent_within`` after the
    first is answered once.  The ids are kept in the stream's state, by key, until the
    watermark has passed that time, so the state does not grow with the stream.
    Requests without an id are all answered.

    Default ``trigger={"availableNow": True}`` drains what is there and stops
    (batch-like runs, tests); a deployment passes e.g.
    ``{"processingTime": "10 seconds"}`` and ``wait=False`` to keep it running.
    Returns the ``StreamingQuery``.
    """
    feats = contract.features
    reader = spark.readStream.schema(request_schema)
    if max_files_per_trigger:                  # bounded micro-batches; default: all new files
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    keys = key_list(key)
    whole = snapshot is None
    req = sent(reader.parquet(requests_path)).withColumn(
        "request_key", F.col(keys[0]).cast("string") if len(keys) == 1 else F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))
    marks = ["request", "request_key"]
    if client_id:
        if not sent_at:
            raise ValueError("client_id needs sent_at, the time by which its state expires")
        # a request without an id is its own: it gets one that no other has
        own = F.coalesce(F.col(client_id).cast("string"), F.concat(F.lit("none-"), F.uuid()))
        req = (req.withColumn("_client", own).withWatermark(sent_at, resent_within)
               .dropDuplicatesWithinWatermark(["_client"]).drop("_client"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        if whole:
            rows = conform(batch, contract, [*marks, *keys, *keep], strict=False)
        else:
            snap = (snapshot() if callable(snapshot) else snapshot).select(*keys, *feats)
            rows = coerce_key(batch, keys, snap).select(*marks, *keys, *keep)
            few = keys_in_scan(snap, rows, keys, push_keys) if push_keys else None
            rows = (rows.join(few, keys, "left") if few is not None
                    else join_hot_split(rows, snap, keys, skew_fraction, "left") if skew_fraction else rows.join(snap, keys, "left"))
        (predict(rows, contract.tree)
             .select(F.concat_ws("-", F.lit(str(batch_id)), F.monotonically_increasing_id().cast("string")).alias("request_id"),
                     *marks, *keys, *feats, "prediction", F.lit(served_model).alias("served_model"), *keep)
             .write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}"))

    q = (req.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})).start())
    if wait:
        q.awaitTermination()
    return q


def request_log(rows: DataFrame, outputs: Sequence[str] = ("prediction",)) -> DataFrame:
    """The request log of a stream's rows: id, key, model, raw request and response as JSON, batch."""
    return rows.select("request_id", "request_key", "served_model", "request",
                       F.to_json(F.struct(*outputs)).alias("response"), F.col("batch").cast("bigint").alias("batch_id"))
