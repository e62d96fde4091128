"""Queries: newest row per key, online snapshot, online request scoring (AGG-1, WIN-1, SNK-6, JN-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlane.operators.features import point_lookup
from churnlane.operators.latest import latest_per_key, publish_snapshot
from churnlane.operators.score import score_requests
from churnlane.plans import common
from churnlane.plans.oracle_sql import BPZ, tree_case
from churnlane.plans.q_features import churn_contract
from churnlane.plans.registry import query
from churnlane.session import scratch_path, unique_name
from churnlane.sources.tables import FEATURES, KEY, events, table

LATEST_SQL = """
SELECT user_id, ts, event_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM events) WHERE rn = 1"""


@query("latest_by_key", LATEST_SQL, "AGG-1 WIN-1")
def q_latest_by_key(spark, sf):
    return latest_per_key(events(spark, sf), "user_id", "ts", "event_id")


@query("online_latest", LATEST_SQL, "SNK-6 WIN-1")
def q_online_latest(spark, sf):
    """Publish the newest-per-key snapshot as a key-clustered full copy and serve from it."""
    name = unique_name("online_events")
    publish_snapshot(latest_per_key(events(spark, sf), "user_id", "ts", "event_id"),
                     scratch_path(spark, "online-events"), "user_id", table=name)
    return spark.read.table(name)


@query("online_score", f"""{BPZ},
r AS (SELECT CAST(customer_id AS varchar) AS request_key FROM base
      UNION ALL
      SELECT c_name FROM customer)
SELECT request_key, TRY_CAST(request_key AS BIGINT) AS customer_id, senior, tenure, monthly, total,
       {tree_case()} AS prediction
FROM r LEFT JOIN z ON z.customer_id = TRY_CAST(request_key AS BIGINT)""", "JN-3 FLT-3 G11")
def q_online_score(spark, sf):
    """Key-only requests (text keys, some not numbers) against the online feature snapshot."""
    name = unique_name("online_features")
    publish_snapshot(common.z(spark, sf).select(KEY, *FEATURES), scratch_path(spark, "online-features"),
                     KEY, table=name)
    snapshot = spark.read.table(name)
    good = (common.b(spark, sf)
            .select(F.col(KEY).cast("string").alias("request_key")))
    # requests that carry a name instead of a numeric key (G11): they match nothing
    junk = (table(spark, sf, "customer")
            .select(F.col("c_name").alias("request_key")))
    req = good.unionByName(junk).withColumn(KEY, F.col("request_key"))
    contract = churn_contract(spark, sf, "unused")
    return score_requests(spark, contract, req, snapshot, KEY)


@query("key_lookup_pushed", f"""{BPZ}
SELECT customer_id, senior, tenure, monthly, total FROM z WHERE customer_id IN (
    SELECT c_custkey FROM customer WHERE c_nationkey = 7 AND c_mktsegment = 'HOUSEHOLD')""", "FLT-3 JN-3 SNK-6")
def q_key_lookup_pushed(spark, sf):
    """Features of one nation's household customers, asked as text, from a published snapshot with Bloom filters: few enough
    keys go into the scan as a filter, more are joined."""
    name = unique_name("online_features")
    publish_snapshot(common.z(spark, sf).select(KEY, *FEATURES), scratch_path(spark, "online-features"), KEY, table=name)
    asked = (table(spark, sf, "customer").where("c_nationkey = 7 AND c_mktsegment = 'HOUSEHOLD'")
             .select(F.col("c_custkey").cast("string").alias(KEY)))
    return point_lookup(spark.read.table(name), asked, KEY, push=200)
