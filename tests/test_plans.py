"""Physical-plan shape of the operators whose scale behaviour depends on it.

Each test reads ``explain()`` output of a plan built on the driver tables and
asserts the property that matters at scale (no Python in the native paths,
no window where an aggregate suffices, no extra exchange, pushdown and
pruning reaching the scan, bucketed reads on the snapshot side).
"""

import contextlib
import io
import re

from pyspark.sql import functions as F

from churnlane.functions.columns import hash_bucket
from churnlane.operators.latest import latest_per_key, publish_snapshot
from churnlane.operators.metrics import column_stats
from churnlane.operators.ordering import row_position
from churnlane.operators.score import score_columns, score_requests
from churnlane.operators.tree import fixed_tree
from churnlane.plans import common
from churnlane.plans.q_features import churn_contract
from churnlane.session import scratch_path, unique_name
from churnlane.sources.tables import events
from tests.conftest import SF_SMALL

FEATS = ["senior", "tenure", "monthly", "total"]


def plan(df, mode=None) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode) if mode else df.explain()
    return buf.getvalue()


def test_native_scoring_stays_in_the_jvm(spark):
    p = plan(score_columns(common.z(spark, SF_SMALL), fixed_tree()))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|PythonUDF", p)


def test_latest_per_key_is_an_aggregate_not_a_window(spark):
    p = plan(latest_per_key(events(spark, SF_SMALL), "user_id", "ts", "event_id"))
    assert "Window" not in p
    assert "partial_max_by" in p                     # map-side partial aggregation
    assert p.count("Exchange hashpartitioning") == 1


def test_row_position_numbers_without_exchange_or_window(spark):
    out = row_position(common.z(spark, SF_SMALL), "customer_id", "pos")
    p = plan(out)
    assert "Exchange" not in p and "Window" not in p   # pinned ranges: one projection
    assert "monotonically_increasing_id" in p


def test_column_stats_plans_hash_dedup_without_expand(spark):
    p = plan(column_stats(common.p(spark, SF_SMALL)))
    assert "Expand" not in p
    # the (column, value) de-duplication is a hash aggregate; only the final
    # global fold (no grouping key) may be sort-based, and it has no Sort below it
    assert "HashAggregate(keys=[k" in p
    assert not re.search(r"SortAggregate\(key=\[[^\]]", p)


def test_filters_and_pruning_reach_the_scan(spark):
    train, _ = common.train_test(spark, SF_SMALL)
    p = plan(train.select("customer_id", "monthly"))
    assert "PushedFilters: [IsNotNull(o_custkey)]" in p
    orders_schema = re.search(r"ReadSchema: (struct<o_[^>]*>)", p).group(1)
    assert "o_orderpriority" not in orders_schema and "o_clerk" not in orders_schema


def test_key_only_requests_prune_the_orders_join(spark):
    keys = common.b(spark, SF_SMALL).where(hash_bucket("customer_id") >= 80).select("customer_id")
    p = plan(keys)
    assert "orders" not in p and "Join" not in p


def test_online_lookup_reads_the_snapshot_bucketed(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")    # the large-snapshot plan
    try:
        name = unique_name("plan_snap")
        publish_snapshot(common.z(spark, SF_SMALL).select("customer_id", *FEATS),
                         scratch_path(spark, "plan-snap"), "customer_id", table=name, buckets=8)
        req = common.b(spark, SF_SMALL).select(F.col("customer_id").cast("string").alias("customer_id"))
        out = score_requests(spark, churn_contract(spark, SF_SMALL, "unused"), req,
                             spark.read.table(name), "customer_id")
        p = plan(out)
        assert "Bucketed: true" in p
        assert p.count("Exchange hashpartitioning") == 1    # only the request side moves
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_feature_lookup_reads_a_bucketed_feature_table_in_place(spark):
    from churnlane.operators.features import FeatureLookup, create_feature_table, lookup
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1")                                        # the large-table plan
    try:
        name = unique_name("plan_ft")
        create_feature_table(spark, name, common.z(spark, SF_SMALL).select("customer_id", *FEATS), ["customer_id"], buckets=8)
        p = plan(lookup(spark, common.b(spark, SF_SMALL).select("customer_id"), [FeatureLookup.of(name, "customer_id")]))
        assert "SortMergeJoin" in p and "Bucketed: true" in p
        assert p.count("Exchange hashpartitioning") == 1               # only the request keys move
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_key_check_on_a_bucketed_feature_table_needs_no_shuffle(spark):
    from churnlane.operators.features import key_violations
    from churnlane.operators.features import create_feature_table
    name = unique_name("plan_ft")
    create_feature_table(spark, name, common.z(spark, SF_SMALL).select("customer_id", *FEATS), ["customer_id"], buckets=8)
    p = plan(key_violations(spark.read.table(name), ["customer_id"]))
    assert "Bucketed: true" in p and "Exchange" not in p


def _largest_task(df):
    n = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    return n[-1], sum(n)


def test_a_hot_request_key_is_split(spark):
    """Half of the requests ask for one key: no task gets more than a quarter of the rows, bucketed or not."""
    from churnlane.operators.features import FeatureLookup, create_feature_table, lookup
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    feats = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("g"), F.rand(1).alias("x"))
    req = spark.range(0, 200_000, 1, 16).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 2000).alias("k"), F.rand(2).alias("v")) \
        .withColumn("g", F.col("k") % 7)
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        plain, bucketed = unique_name("hot_plain"), unique_name("hot_bucketed")
        create_feature_table(spark, plain, feats.drop("g"), ["k"])
        create_feature_table(spark, bucketed, feats.drop("g"), ["k"], buckets=8)
        both = unique_name("hot_both")
        create_feature_table(spark, both, feats, ["k", "g"], buckets=8)
        for name, keys, fraction in ((plain, ["k"], None), (bucketed, ["k"], 0.01), (both, ["k", "g"], 0.01)):
            out = lookup(spark, req, [FeatureLookup.of(name, keys)], skew_fraction=fraction)
            most, rows = _largest_task(out)
            assert rows == 200_000 and most <= rows / 4, (name, most)
            assert out.where("x is null").count() == 0
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_null_key_is_in_exactly_one_part(spark):
    from churnlane.operators.split import hash_split
    a, b = hash_split(spark.createDataFrame([(1,), (2,), (None,)], "customer_id bigint"))
    assert a.count() + b.count() == 3 and b.where("customer_id is null").count() == 1
