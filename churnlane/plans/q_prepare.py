"""Queries: read, prepare, project, split, requests (SRC-1, SRC-3, PRJ-*, FLT-1/2, FN-*, SPL-*, CTR-2)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.functions.columns import (cast_by_type, drop_columns, hash_bucket, last_name_part,
                                         pack, route_name)
from churnlane.operators.contract import Contract, conform
from churnlane.operators.prepare import prepare as prepare_op
from churnlane.operators.split import input_example, random_split, split_xy
from churnlane.operators.tree import fixed_tree, predict
from churnlane.plans import common
from churnlane.plans.oracle_sql import BASE, BPZ, BPZS, P, bucket, tree_case, with_ctes
from churnlane.plans.registry import query
from churnlane.session import scratch_path
from churnlane.sources.files import records_to_rows, scan_csv, write_csv
from churnlane.sources.tables import FEATURES, KEY, LABEL, table

FEATURE_SCHEMA = T.StructType([T.StructField(f, T.DoubleType()) for f in FEATURES])


@query("prepare", f"{BPZ} SELECT * FROM z", "PRJ-2 FLT-1 FN-1")
def q_prepare(spark, sf):
    return common.z(spark, sf)


@query("scan_csv", f"{BPZ} SELECT * FROM z", "SRC-1")
def q_scan_csv(spark, sf):
    """Write ``base`` as many CSV files, read back with inferred types, prepare."""
    path = scratch_path(spark, "csv-base")
    write_csv(common.b(spark, sf), path)
    raw = scan_csv(spark, path)
    # inference types the key as int; the table key type is bigint
    return prepare_op(raw.withColumn(KEY, F.col(KEY).cast("bigint")))


@query("cast_by_type", f"""{with_ctes(BASE)}
SELECT customer_id, CAST(senior AS double) AS senior, CAST(tenure AS double) AS tenure,
       monthly, total, churn FROM base""", "PRJ-3")
def q_cast_by_type(spark, sf):
    return cast_by_type(common.b(spark, sf), T.IntegerType, "double")


@query("drop_columns", f"{BPZ} SELECT senior, tenure, monthly, total FROM z", "PRJ-4 PRJ-5")
def q_drop_columns(spark, sf):
    # absent names ignored, names matched case-insensitively
    return drop_columns(common.z(spark, sf), "CUSTOMER_ID", LABEL, "not_a_column")


@query("features_labels", f"{BPZS} SELECT customer_id, senior, tenure, monthly, total FROM train", "PRJ-1")
def q_features_labels(spark, sf):
    """``features_df = train.select(key, *features)`` (the labels are ``select(key, label)``)."""
    train, _ = common.train_test(spark, sf)
    return train.select(KEY, *FEATURES)


@query("struct_pack", f"{BPZ} SELECT customer_id, senior, tenure, monthly, total FROM z", "PRJ-6 FN-2")
def q_struct_pack(spark, sf):
    packed = common.z(spark, sf).select(KEY, pack(FEATURES, "features"))
    return packed.select(KEY, "features.*")


@query("complete_subset", f"""{with_ctes(BASE, P)}
SELECT customer_id, senior, tenure, monthly, total FROM p
WHERE customer_id IS NOT NULL AND senior IS NOT NULL AND tenure IS NOT NULL
  AND monthly IS NOT NULL AND total IS NOT NULL""", "FLT-2")
def q_complete_subset(spark, sf):
    """Pipeline-style completeness: only over the selected columns (G3)."""
    sel = [KEY, *FEATURES]
    return prepare_op(common.b(spark, sf).select(*sel), subset=sel)


@query("hash_split", f"""{BPZ}
SELECT *, CASE WHEN {bucket('customer_id')} < 80 THEN 'train' ELSE 'test' END AS part FROM z""", "SPL-1")
def q_hash_split(spark, sf):
    return common.z(spark, sf).withColumn(
        "part", F.when(hash_bucket(KEY) < 80, "train").otherwise("test"))


@query("random_split", f"{BPZ} SELECT *, CAST(1 AS BIGINT) AS parts FROM z", "SPL-1")
def q_random_split(spark, sf):
    """Which part a row falls into is random; that each falls into exactly one is not."""
    train, test = random_split(common.z(spark, sf), (0.8, 0.2), 42)
    both = train.unionByName(test)
    return both.groupBy(*both.columns).agg(F.count("*").alias("parts"))


@query("split_xy", f"""{BPZ}
SELECT *, CASE WHEN {bucket('customer_id')} < 80 THEN 'train' ELSE 'test' END AS part FROM z""", "SPL-2")
def q_split_xy(spark, sf):
    """Features and labels split in one pass (the tagged frame the four parts project from)."""
    return split_xy(common.z(spark, sf), KEY, FEATURES, LABEL)["xy"]


@query("input_example", f"""{BPZS}
SELECT customer_id, senior, tenure, monthly, total FROM train ORDER BY customer_id LIMIT 3""", "SPL-4")
def q_input_example(spark, sf):
    train, _ = common.train_test(spark, sf)
    return input_example(train.select(KEY, *FEATURES), KEY, 3)


@query("name_parts", """
SELECT c_custkey AS customer_id,
       concat('main.', lower(c_mktsegment), '.churn_model') AS model_name,
       'churn_model' AS short_name,
       concat('churn_model', '-', CAST(c_nationkey AS varchar)) AS route
FROM customer""", "FN-3 FN-4")
def q_name_parts(spark, sf):
    c = table(spark, sf, "customer")
    full = F.concat(F.lit("main."), F.lower("c_mktsegment"), F.lit(".churn_model"))
    return (c.select(F.col("c_custkey").alias(KEY), full.alias("model_name"), "c_nationkey")
             .withColumn("short_name", last_name_part("model_name"))
             .withColumn("route", route_name(F.col("short_name"), F.col("c_nationkey")))
             .drop("c_nationkey"))


def _request_source(spark, sf):
    """Every customer as a client would send them: ints for int-like features (G19)."""
    p = common.p(spark, sf)
    return p.select(
        KEY, F.col("senior").cast("int").alias("senior"), F.col("tenure").cast("int").alias("tenure"),
        "monthly", "total")


_REQ_SQL = f"""{with_ctes(BASE, P)}
SELECT customer_id, senior, tenure, monthly, total, {tree_case()} AS prediction
FROM p"""


@query("json_requests", _REQ_SQL, "FN-6 SRC-3")
def q_json_requests(spark, sf):
    """One JSON record per request body; NULL features are simply absent fields."""
    req = _request_source(spark, sf)
    bodies = req.select(KEY, F.to_json(F.struct(*FEATURES)).alias("body"))
    parsed = bodies.select(KEY, F.from_json("body", FEATURE_SCHEMA).alias("r")).select(KEY, "r.*")
    return predict(parsed, fixed_tree())


@query("inline_requests", _REQ_SQL, "SRC-3 FN-6")
def q_inline_requests(spark, sf):
    """Request bodies holding a *list* of records (``dataframe_records``).

    Bodies group at most ten consecutive keys (``customer_id div 10`` of a
    unique key, so every group is bounded), then are exploded back to rows.
    """
    req = _request_source(spark, sf)
    rec = F.struct(F.col(KEY).cast("string").alias(KEY), *FEATURES)
    bodies = (req.groupBy((F.col(KEY) / 10).cast("bigint").alias("request_id"))
                 .agg(F.to_json(F.collect_list(rec)).alias("body")))
    rows = records_to_rows(bodies, "body", T.StructType(
        [T.StructField(KEY, T.StringType())] + list(FEATURE_SCHEMA.fields)))
    rows = rows.withColumn(KEY, F.col(KEY).try_cast("bigint"))
    return predict(rows.select(KEY, *FEATURES), fixed_tree())


@query("conform", f"{with_ctes(BASE, P)} SELECT customer_id, senior, tenure, monthly, total FROM p", "CTR-2")
def q_conform(spark, sf):
    contract = Contract(FEATURE_SCHEMA, LABEL, ("No", "Yes"))
    raw = common.b(spark, sf).select(KEY, F.col("senior").alias("SENIOR"), "tenure", "monthly",
                                     "total", "churn")
    return conform(raw, contract, keep=[KEY], strict=False)      # blanks in total are missing values
