"""Queries: feature tables, key checks, lookups (SRC-4, SNK-3/4, KEY-1, FLT-3, JN-1, JN-2, JN-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlane.functions.columns import hash_bucket
from churnlane.operators.contract import Contract, ModelStore, capture_schema
from churnlane.operators.features import (FeatureLookup, create_feature_table,
                                          create_training_set, key_violations, lookup_skew_safe,
                                          missing_features, point_lookup)
from churnlane.operators.score import score_batch
from churnlane.operators.tree import fixed_tree, predict
from churnlane.plans import common
from churnlane.plans.oracle_sql import BPZ, BPZS, bucket, tree_case
from churnlane.plans.registry import query
from churnlane.operators.split import hash_split
from churnlane.session import pin, scratch_path, unique_name
from churnlane.sources.tables import FEATURES, KEY, LABEL, table


def churn_feature_table(spark, sf, z=None):
    """Feature table of all prepared rows: key + 4 double features (checked unique key)."""
    name = unique_name("churn_features")
    z = common.z(spark, sf) if z is None else z
    # not bucketed: AQE can split a hot request key only if both sides are shuffled
    return name, create_feature_table(spark, name, z.select(KEY, *FEATURES), [KEY],
                                      "churn features per customer")


def churn_contract(spark, sf, table_name: str, tenure_cut: float = 1800.0) -> Contract:
    z = common.z(spark, sf)
    return Contract(capture_schema(z, FEATURES), LABEL, ("No", "Yes"), "string",
                    (FeatureLookup.of(table_name, KEY),), KEY, fixed_tree(tenure_cut))


@query("feature_table", f"{BPZ} SELECT customer_id, senior, tenure, monthly, total FROM z", "SNK-3 SNK-4 SRC-4")
def q_feature_table(spark, sf):
    _, ft = churn_feature_table(spark, sf)
    return ft


@query("pk_violations", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey
HAVING count(*) > 1 OR o_custkey IS NULL""", "KEY-1")
def q_pk_violations(spark, sf):
    return key_violations(table(spark, sf, "orders"), ["o_custkey"])


@query("training_set", f"""{BPZS}
SELECT t.churn, z.senior, z.tenure, z.monthly, z.total
FROM (SELECT customer_id, churn FROM train) t LEFT JOIN z USING (customer_id)""", "JN-1")
def q_training_set(spark, sf):
    """Labels of the 80% side + every non-key feature of the lookup table, key excluded."""
    zz = pin(common.z(spark, sf))                 # feeds the feature table and the labels
    name, _ = churn_feature_table(spark, sf, zz)
    train, _ = hash_split(zz)
    spec = create_training_set(train.select(KEY, LABEL), LABEL, [FeatureLookup.of(name, KEY)],
                               exclude_columns=[KEY])
    return spec.load_df(spark)


_SCORE_KEYS = f"(SELECT customer_id FROM base WHERE {bucket('customer_id')} >= 80)"


@query("score_batch", f"""{BPZ}
SELECT k.customer_id, senior, tenure, monthly, total, {tree_case()} AS prediction
FROM {_SCORE_KEYS} k LEFT JOIN z USING (customer_id)""", "JN-2 SCO-1 CTR-3 SNK-9")
def q_score_batch(spark, sf):
    """Held-out keys (of all customers) -> model resolved by alias -> its own lookups -> prediction.

    The model is logged with its contract (feature lookups + tree), resolved
    as ``churn_model@champion`` and scored with no table argument: the
    contract says which feature table to join.
    """
    name, _ = churn_feature_table(spark, sf)
    store = ModelStore(spark, scratch_path(spark, "models"))
    store.log_model("churn_model", churn_contract(spark, sf, name), aliases=["Champion"])
    contract = store.load_contract("churn_model@champion")
    keys = common.b(spark, sf).where(hash_bucket(KEY) >= 80).select(KEY)
    return score_batch(spark, contract, keys, "string")


@query("missing_features", f"""{BPZ}
SELECT customer_id FROM base b WHERE NOT EXISTS (SELECT 1 FROM z WHERE z.customer_id = b.customer_id)""",
       "JN-4")
def q_missing_features(spark, sf):
    name, _ = churn_feature_table(spark, sf)
    keys = common.b(spark, sf).select(KEY)
    return missing_features(spark, keys, [FeatureLookup.of(name, KEY)])


_URGENT_KEYS = """(SELECT DISTINCT CAST(o_custkey AS varchar) AS k FROM orders
   WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= timestamp '2000-07-01')"""


@query("key_lookup", f"""{BPZ}
SELECT customer_id, senior, tenure, monthly, total FROM z
WHERE customer_id IN (SELECT TRY_CAST(k AS BIGINT) FROM {_URGENT_KEYS})""", "FLT-3 G11")
def q_key_lookup(spark, sf):
    """Point lookup of requested keys sent as text: features of every customer with an
    urgent order after the cutoff (request keys come as strings), as a semi-join."""
    name, ft = churn_feature_table(spark, sf)
    req = (table(spark, sf, "orders")
           .where((F.col("o_orderpriority") == "1-URGENT")
                  & (F.col("o_orderdate") >= F.lit("2000-07-01").cast("timestamp_ntz")))
           .select(F.col("o_custkey").cast("string").alias(KEY)))
    return point_lookup(ft, req, KEY)


@query("score_orders", f"""{BPZ}
SELECT o_orderkey, o_custkey AS customer_id, senior, tenure, monthly, total, {tree_case()} AS prediction
FROM orders LEFT JOIN z ON z.customer_id = o_custkey""", "JN-2 SCO-1")
def q_score_orders(spark, sf):
    """Score every order by its customer's features: a request side with repeated keys.

    Uses the hot-key split lookup, so a customer owning a large share of all
    orders is served from a bounded broadcast instead of one shuffle task.
    """
    name, _ = churn_feature_table(spark, sf)
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias(KEY))
    joined = lookup_skew_safe(spark, orders, FeatureLookup.of(name, KEY), fraction=0.01)
    return predict(joined, fixed_tree())
