"""Queries: typed tables, evolving append, clustering, compaction, partitioning, Z-order,
request capture (SNK-1, SNK-2, SNK-7, LAY-1..4)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.functions.columns import hash_bucket
from churnlane.operators.curves import hilbert
from churnlane.operators.features import lookup
from churnlane.operators.layout import compact, partitioned_write, write_clustered, zorder
from churnlane.operators.score import score_batch, score_columns
from churnlane.operators.tree import fixed_tree, predict
from churnlane.operators.upkeep import compact_files, file_facts
from churnlane.plans import common
from churnlane.plans.oracle_sql import BASE, BPZ, P, bucket, tree_case, with_ctes
from churnlane.plans.q_features import churn_contract, churn_feature_table
from churnlane.plans.registry import query
from churnlane.session import default_buckets, pin, scratch_path, unique_name
from churnlane.sources.sinks import (append_evolve, capture_frame, create_typed_table, parse_capture,
                                     sent, write_table)
from churnlane.sources.tables import FEATURES, KEY, table

INFERENCE_DDL = ("customer_id BIGINT, churn STRING, senior DOUBLE, tenure DOUBLE, monthly DOUBLE, "
                 "total DOUBLE, prediction STRING")
CLUSTER = ["customer_id", "tenure"]

_INFERENCE_SQL = f"{BPZ} SELECT customer_id, churn, senior, tenure, monthly, total, {tree_case()} AS prediction FROM z"


def _inference_rows(spark, sf):
    return score_columns(common.z(spark, sf), fixed_tree())


def _files(spark) -> int:
    """Output file count for the key-level inference table: the shuffle partition
    count, sized from the input; ``compact`` resizes from the real bytes."""
    return default_buckets(spark)


@query("clustered_write", _INFERENCE_SQL, "SNK-1 LAY-1")
def q_clustered_write(spark, sf):
    """Typed table clustered by (customer_id, tenure); rows appended as clustered files."""
    name = create_typed_table(spark, unique_name("batch_inference"), INFERENCE_DDL, CLUSTER,
                              "scored customers")
    write_clustered(spark, _inference_rows(spark, sf), name, CLUSTER, _files(spark), "append")
    return spark.read.table(name)


@query("compact", _INFERENCE_SQL, "LAY-2 LAY-3")
def q_compact(spark, sf):
    """Many small files -> ALTER ... CLUSTER BY -> rewrite to size-based file count, same rows."""
    name = write_table(spark, _inference_rows(spark, sf).repartition(4 * _files(spark)), "fragmented")
    spark.sql(f"ALTER TABLE {name} CLUSTER BY (customer_id, tenure)")
    compact(spark, name)
    return spark.read.table(name)


@query("layout_partitioned", _INFERENCE_SQL, "LAY-4")
def q_layout_partitioned(spark, sf):
    """Hive-style partitions by a low-cardinality column; partition pruning on read."""
    path = scratch_path(spark, "by-senior")
    partitioned_write(_inference_rows(spark, sf), path, "senior")
    return spark.read.parquet(path)


@query("zorder_layout", _INFERENCE_SQL, "LAY-4")
def q_zorder_layout(spark, sf):
    """Z-ordered files over (tenure, monthly): same rows, files local in both columns."""
    path = scratch_path(spark, "zorder")
    zorder(_inference_rows(spark, sf), ["tenure", "monthly"], _files(spark)).write.parquet(path)
    return spark.read.parquet(path)


@query("append_evolve", f"""{BPZ},
k AS (SELECT customer_id FROM base WHERE {bucket('customer_id')} >= 80),
s AS (SELECT k.customer_id, senior, tenure, monthly, total FROM k LEFT JOIN z USING (customer_id))
SELECT customer_id, CAST(NULL AS varchar) AS churn, senior, tenure, monthly, total,
       {tree_case()} AS prediction, CAST(NULL AS INTEGER) AS model_version FROM s
UNION ALL
SELECT customer_id, CAST(NULL AS varchar), senior, tenure, monthly, total,
       {tree_case(tenure_cut=1600.0)}, 2 FROM s""", "SNK-1 SNK-2 G8")
def q_append_evolve(spark, sf):
    """Append scored keys (no churn column -> NULL), then a batch with a NEW column."""
    ft, _ = churn_feature_table(spark, sf)
    keys = common.b(spark, sf).where(hash_bucket(KEY) >= 80).select(KEY)
    name = create_typed_table(spark, unique_name("batch_inference"), INFERENCE_DDL)
    contract = churn_contract(spark, sf, ft)
    found = pin(lookup(spark, keys, contract.lookups))            # both versions look the same keys up in the same table
    append_evolve(spark, predict(found, contract.tree), name)
    append_evolve(spark, predict(found, churn_contract(spark, sf, ft, tenure_cut=1600.0).tree).withColumn("model_version", F.lit(2)), name)
    return spark.read.table(name)


@query("capture_log", f"""{with_ctes(BASE, P)}
SELECT CAST(customer_id AS varchar) AS request_id, 'churn_model-1' AS served_model,
       CAST(0 AS BIGINT) AS batch_id, senior, tenure, monthly, total, {tree_case()} AS prediction
FROM p""", "SNK-7 STR-3")
def q_capture_log(spark, sf):
    """Requests + responses appended to a capture table as JSON, parsed back."""
    p = common.p(spark, sf)
    scored = score_columns(sent(p.select(KEY, *FEATURES)), fixed_tree())
    log = capture_frame(scored, ["prediction"], "churn_model-1", request_id=KEY, batch_id=0)
    name = write_table(spark, log, "capture_log", mode="append")
    qs = T.StructType([T.StructField(f, T.DoubleType()) for f in FEATURES])
    rs = T.StructType([T.StructField("prediction", T.StringType())])
    return parse_capture(spark.read.table(name), qs, rs)


@query("capture_requests", f"""{BPZ}
SELECT o_custkey AS sent_id, o_orderpriority AS sent_note, CAST(NULL AS DOUBLE) AS sent_tenure, 'churn_model-1' AS served_model, CAST(1 AS BIGINT) AS rows_of_id, {tree_case()} AS prediction
FROM orders LEFT JOIN z ON customer_id = o_custkey""", "SNK-7 JN-2")
def q_capture_requests(spark, sf):
    """One request an order, customers repeated: features are looked up, but the log has what was sent, under an id of each request's own."""
    ft, _ = churn_feature_table(spark, sf)
    asked = table(spark, sf, "orders").select(F.col("o_custkey").alias(KEY), F.col("o_orderpriority").alias("note"))
    scored = score_batch(spark, churn_contract(spark, sf, ft), sent(asked))
    name = write_table(spark, capture_frame(scored, ["prediction"], "churn_model-1", batch_id=7), "request_log", mode="append")
    fields = T.StructType().add(KEY, "long").add("note", "string").add("tenure", "double")
    log = parse_capture(spark.read.table(name), fields, T.StructType().add("prediction", "string"))
    return log.groupBy("request_id").agg(
        F.first(KEY).alias("sent_id"), F.first("note").alias("sent_note"), F.first("tenure").alias("sent_tenure"),
        F.first("served_model").alias("served_model"), F.count("*").alias("rows_of_id"), F.first("prediction").alias("prediction")).drop("request_id")


@query("hilbert_layout", _INFERENCE_SQL, "LAY-1 LAY-4")
def q_hilbert_layout(spark, sf):
    """Files along a Hilbert curve over (tenure, monthly): same rows, every file narrow in both columns."""
    path = scratch_path(spark, "hilbert")
    hilbert(_inference_rows(spark, sf), ["tenure", "monthly"], _files(spark)).write.parquet(path)
    return spark.read.parquet(path)


@query("compact_files", f"""{BPZ}
SELECT customer_id, churn, senior, tenure, monthly, total, {tree_case()} AS prediction, true AS kept_files FROM z""", "LAY-3 SNK-2")
def q_compact_files(spark, sf):
    """A clustered table of eight files, to which a tenth of the customers was appended in small ones: only those are rewritten,
    the eight keep their names."""
    rows = pin(_inference_rows(spark, sf))
    name = create_typed_table(spark, unique_name("inference"), INFERENCE_DDL, CLUSTER)
    late = hash_bucket(KEY, "late:") < 10
    write_clustered(spark, rows.where(~late), name, CLUSTER, 8)
    before = {f.path: f.size for f in file_facts(spark.read.table(name), KEY)}
    write_clustered(spark, rows.where(late), name, CLUSTER, 4)
    compact_files(spark, name, target_bytes=2 * min(before.values()) if before else 1, max_overlap=2)
    after = {f.path for f in file_facts(spark.read.table(name), KEY)}
    kept = set(before) <= after and len(after) < len(before) + 4
    return spark.read.table(name).withColumn("kept_files", F.lit(kept or not before))
