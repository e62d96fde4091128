"""Queries: streaming request scoring, request log, streaming snapshot (STR-1..3).

Stream inputs are derived from the given tables: Spark writes them as several
files (hash parts of the key) so the stream sees several micro-batches.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.operators.latest import publish_snapshot
from churnlane.plans import common
from churnlane.plans.oracle_sql import BASE, BPZ, tree_case, with_ctes
from churnlane.plans.q_features import churn_contract
from churnlane.plans.q_online import LATEST_SQL
from churnlane.plans.registry import query
from churnlane.session import scratch_path, staged, unique_name
from churnlane.sources.tables import FEATURES, KEY, events, table
from churnlane.streaming.keyed import merged_changes, newest_changes
from churnlane.streaming.scoring import request_log, score_stream
from churnlane.streaming.snapshot import current_snapshot, maintain_latest

PARTS = 4


def _write_parts(df, path: str) -> int:
    """Stage stream input as many files (round-robin, so each file holds rows
    from everywhere); returns ``maxFilesPerTrigger`` giving ~PARTS micro-batches."""
    files = max(PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))
    df.repartition(files).write.mode("overwrite").parquet(path)
    return max(1, files // PARTS)


def _run_score_stream(spark, sf, keys):
    req_path = scratch_path(spark, "requests")
    per_trigger = _write_parts(keys, req_path)
    snap = unique_name("stream_features")
    publish_snapshot(common.z(spark, sf).select(KEY, *FEATURES), scratch_path(spark, "online-features"),
                     KEY, table=snap)
    out = scratch_path(spark, "stream-out")
    # the snapshot is read by name for every micro-batch, so a refresh is seen
    score_stream(spark, req_path, T.StructType([T.StructField(KEY, T.StringType())]),
                 lambda: spark.read.table(snap), churn_contract(spark, sf, "unused"), KEY, out,
                 scratch_path(spark, "stream-ckpt"), "churn_model-1", per_trigger)
    return spark.read.parquet(out)


@query("stream_score", f"""{BPZ}
SELECT k.customer_id, senior, tenure, monthly, total, {tree_case()} AS prediction
FROM (SELECT customer_id FROM base) k LEFT JOIN z USING (customer_id)""",
       "STR-1 JN-3")
def q_stream_score(spark, sf):
    keys = common.b(spark, sf).select(F.col(KEY).cast("string").alias(KEY))
    return _run_score_stream(spark, sf, keys).select(KEY, *FEATURES, "prediction")


@query("stream_capture", f"""{BPZ},
r AS (SELECT CAST(o_custkey AS varchar) AS request_key FROM orders
      UNION ALL SELECT c_name FROM customer)
SELECT request_key, 'churn_model-1' AS served_model, request_key AS sent_key, CAST(1 AS BIGINT) AS rows_of_id,
       {tree_case()} AS prediction
FROM r LEFT JOIN z ON z.customer_id = TRY_CAST(request_key AS BIGINT)""",
       "STR-3 SNK-7")
def q_stream_capture(spark, sf):
    """The log of one request an order (keys repeat) and one a customer's name (no key at all): every
    request is logged as it came, under an id of its own."""
    keys = (table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias(KEY))
            .unionByName(table(spark, sf, "customer").select(F.col("c_name").alias(KEY))))
    log = request_log(_run_score_stream(spark, sf, keys))
    parsed = log.select("request_id", "request_key", "served_model",
                        F.get_json_object("request", f"$.{KEY}").alias("sent_key"),
                        F.get_json_object("response", "$.prediction").alias("prediction"))
    return parsed.groupBy("request_id").agg(
        *[F.first(c).alias(c) for c in ("request_key", "served_model", "sent_key", "prediction")],
        F.count("*").alias("rows_of_id")).drop("request_id")


@query("stream_full_requests", f"""{with_ctes(BASE)},
r AS (SELECT customer_id, CAST(senior AS double) AS senior, CAST(tenure AS double) AS tenure, monthly,
             TRY_CAST(total AS double) AS total FROM base)
SELECT *, {tree_case()} AS prediction FROM r""", "STR-1 CTR-2")
def q_stream_full_requests(spark, sf):
    """Requests that carry every feature as text, blanks included: conformed, no lookup."""
    req = common.b(spark, sf).select(KEY, *[F.col(f).cast("string").alias(f) for f in FEATURES])
    path, out = scratch_path(spark, "requests"), scratch_path(spark, "stream-out")
    per_trigger = _write_parts(req, path)
    score_stream(spark, path, req.schema, None, churn_contract(spark, sf, "unused"), KEY, out,
                 scratch_path(spark, "stream-ckpt"), "churn_model-1", per_trigger)
    return spark.read.parquet(out).select(KEY, *FEATURES, "prediction")


@query("stream_latest", LATEST_SQL, "STR-2 SNK-6 WIN-1")
def q_stream_latest(spark, sf):
    """Events arrive in four interleaved micro-batches; the snapshot equals the batch result."""
    ev = events(spark, sf)
    src = scratch_path(spark, "events-stream")
    per_trigger = _write_parts(ev, src)
    root = scratch_path(spark, "latest-snapshot")
    # four micro-batches with a fold after the third: the result merges a full
    # copy with the change set that came after it
    maintain_latest(spark, src, ev.schema, root, scratch_path(spark, "latest-ckpt"),
                    "user_id", "ts", "event_id", per_trigger, compact_every=3)
    return current_snapshot(spark, root)


@query("stream_resent", f"""{BPZ}
SELECT o_orderkey AS client, customer_id, CAST(1 AS BIGINT) AS answers, {tree_case()} AS prediction
FROM orders LEFT JOIN z ON customer_id = o_custkey""", "STR-3 STR-1")
def q_stream_resent(spark, sf):
    """One request an order, every one sent again later; the stream is stopped in between.  Each is answered once."""
    asked = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("client"), F.col("o_orderdate").cast("timestamp").alias("sent_at"),
                                              F.col("o_custkey").cast("string").alias(KEY))
    path, out, ckpt = (scratch_path(spark, n) for n in ("requests", "stream-out", "stream-ckpt"))
    features = staged(common.z(spark, sf).select(KEY, *FEATURES), "online-features")[0]
    for again in ("0 seconds", "20 minutes"):
        asked.withColumn("sent_at", F.col("sent_at") + F.expr(f"INTERVAL {again}")).write.mode("append").parquet(path)
        score_stream(spark, path, asked.schema, features, churn_contract(spark, sf, "unused"), KEY, out, ckpt, "churn_model-1",
                     keep=["client"], client_id="client", sent_at="sent_at", resent_within="3650 days")
    rows = spark.read.parquet(out)
    return rows.groupBy(F.col("client").cast("long").alias("client")).agg(
        F.first(F.when(F.col("senior").isNotNull(), F.col(KEY))).alias(KEY), F.count("*").alias("answers"), F.first("prediction").alias("prediction"))


@query("stream_composite", f"""{BPZ},
r AS (SELECT CAST(customer_id AS varchar) AS k, 'Yes' AS churn FROM base UNION ALL SELECT 'x', 'No')
SELECT TRY_CAST(k AS BIGINT) AS customer_id, r.churn, senior, tenure, monthly, total, {tree_case()} AS prediction
FROM r LEFT JOIN z ON z.customer_id = TRY_CAST(k AS BIGINT) AND z.churn = r.churn""", "STR-1 JN-3")
def q_stream_composite(spark, sf):
    """Requests by a key of two columns, one of them text that must be a number."""
    asked = common.b(spark, sf).select(F.col(KEY).cast("string").alias(KEY), F.lit("Yes").alias("churn"))
    asked = asked.unionByName(spark.createDataFrame([("x", "No")], f"{KEY} string, churn string"))
    path, out = scratch_path(spark, "requests"), scratch_path(spark, "stream-out")
    per_trigger = _write_parts(asked, path)
    features = staged(common.z(spark, sf).select(KEY, "churn", *FEATURES), "online-features")[0]
    score_stream(spark, path, asked.schema, features, churn_contract(spark, sf, "unused"), [KEY, "churn"], out,
                 scratch_path(spark, "stream-ckpt"), "churn_model-1", per_trigger)
    return spark.read.parquet(out).select(KEY, "churn", *FEATURES, "prediction")


@query("stream_keyed_state", f"SELECT *, CAST(1 AS BIGINT) AS changes FROM ({LATEST_SQL})", "STR-2 WIN-1")
def q_stream_keyed_state(spark, sf):
    """Events twice, the second time all of them late: the state puts a key's newest row out once, after a restart too."""
    ev = events(spark, sf)
    src, out, ckpt = (scratch_path(spark, n) for n in ("events-stream", "newest-changes", "newest-ckpt"))
    for k in range(2):
        ev.withColumn("_part", F.lit(k)).drop("_part").coalesce(4).write.mode("append").parquet(src)
        newest_changes(spark, src, ev.schema, out, ckpt, "user_id", "ts", "event_id")
    changes = spark.read.parquet(out).groupBy("user_id").agg(F.count("*").alias("changes"))
    return merged_changes(spark, out, "user_id", "ts", "event_id").join(changes, "user_id")
