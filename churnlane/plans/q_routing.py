"""Queries: traffic split and champion/challenger (SPL-3, SCO-5, SCO-6, SET-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlane.functions.columns import hash_bucket
from churnlane.operators.routing import agreement, assign, score_both, score_routed, version_routes
from churnlane.operators.tree import fixed_tree
from churnlane.plans import common
from churnlane.plans.oracle_sql import BASE, BPZ, P, bucket, tree_case, with_ctes
from churnlane.plans.registry import query
from churnlane.sources.tables import FEATURES, KEY

ROUTES = version_routes("churn_model", [1, 2], [50, 50])
MODELS = {"churn_model-1": fixed_tree(1800.0), "churn_model-2": fixed_tree(1600.0)}

_VARIANT = f"CASE WHEN {bucket('customer_id', 'route:')} < 50 THEN 'churn_model-1' ELSE 'churn_model-2' END"


@query("ab_assign", f"""{with_ctes(BASE)}
SELECT customer_id, {bucket('customer_id', 'route:')} AS route_bucket, {_VARIANT} AS variant FROM base""",
       "SPL-3 FN-4")
def q_ab_assign(spark, sf):
    b = common.b(spark, sf).select(KEY)
    return assign(b.withColumn("route_bucket", hash_bucket(KEY, "route:")), KEY, ROUTES)


@query("ab_score", f"""{with_ctes(BASE, P)}
SELECT customer_id, {_VARIANT} AS variant,
       CASE WHEN {_VARIANT} = 'churn_model-1' THEN {tree_case()} ELSE {tree_case(tenure_cut=1600.0)} END AS prediction
FROM p""", "SCO-5")
def q_ab_score(spark, sf):
    p = common.p(spark, sf).select(KEY, *FEATURES)
    return score_routed(p, KEY, ROUTES, MODELS).select(KEY, "variant", "prediction")


@query("ab_compare", f"""{with_ctes(BASE, P)}
SELECT variant, prediction, count(*) AS n FROM (
  SELECT {_VARIANT} AS variant,
         CASE WHEN {_VARIANT} = 'churn_model-1' THEN {tree_case()} ELSE {tree_case(tenure_cut=1600.0)} END AS prediction
  FROM p) GROUP BY variant, prediction""", "SCO-6")
def q_ab_compare(spark, sf):
    p = common.p(spark, sf).select(KEY, *FEATURES)
    return score_routed(p, KEY, ROUTES, MODELS).groupBy("variant", "prediction").agg(
        F.count(F.lit(1)).alias("n"))


@query("ab_both", f"""{BPZ}
SELECT customer_id, 'churn_model-1' AS variant, {tree_case()} AS prediction FROM z
UNION ALL
SELECT customer_id, 'churn_model-2', {tree_case(tenure_cut=1600.0)} FROM z""", "SET-1")
def q_ab_both(spark, sf):
    z = common.z(spark, sf).select(KEY, *FEATURES)
    return score_both(z, KEY, MODELS).select(KEY, "variant", "prediction")


@query("ab_agreement", f"""{with_ctes(BASE, P)},
s AS (SELECT {tree_case()} AS a, {tree_case(tenure_cut=1600.0)} AS b FROM p),
c AS (SELECT count(*) AS n,
             CAST(sum(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS scored,
             CAST(sum(CASE WHEN a = b THEN 1 ELSE 0 END) AS BIGINT) AS agree FROM s)
SELECT n, scored, agree,
       CASE WHEN scored > 0 THEN floor(CAST(scored - agree AS double) / CAST(scored AS double) * 1000000) / 1000000 END
         AS disagreement_rate
FROM c""", "SCO-6")
def q_ab_agreement(spark, sf):
    return agreement(common.p(spark, sf), MODELS)
