"""Operator tests on hand-made frames and invariants (blank numbers, quoted newlines,
duplicate/NULL keys, text keys, missing fields, empty input, single class, partition
invariance, path agreement, restart of a stream)."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.functions.columns import hash_bucket
from churnlane.operators.contract import Contract, ContractError, ModelStore, conform
from churnlane.operators.features import (FeatureLookup, KeyViolation, create_feature_table,
                                          key_violations, lookup_skew_safe)
from churnlane.operators.latest import latest_per_key
from churnlane.operators.ordering import row_position
from churnlane.operators.prepare import prepare
from churnlane.operators.routing import Route, assign
from churnlane.operators.score import (multi_udf, score_columns, score_map, score_multi,
                                       score_requests, score_stored, score_struct)
from churnlane.operators.split import hash_split
from churnlane.operators.train import best_split, fit_tree, leaf_class_counts
from churnlane.operators.tree import (Leaf, Split, TreeSpec, fixed_tree, from_saved_model,
                                      predict, predict_numpy)
from churnlane.plans import common
from churnlane.session import scratch_path, unique_name
from churnlane.sources.files import records_to_rows, scan_csv
from churnlane.sources.sinks import append_evolve, create_typed_table
from tests.conftest import SF_MID, SF_SMALL

FEATS = ["senior", "tenure", "monthly", "total"]
FSCHEMA = T.StructType([T.StructField(f, T.DoubleType()) for f in FEATS])


def test_csv_quoted_newline_doubled_quote_blank_number(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text('customer_id,note,senior,tenure,monthly,total,churn\n'
                 '1,"two\nlines",0,12,65.5,800.25,No\n'
                 '2,"say ""hi""",1,24,40.0, ,Yes\n'
                 '3,plain,0,3,20.0,60.0,No\n')
    df = scan_csv(spark, str(p))
    assert dict(df.dtypes)["total"] == "string"      # blank forces text, like TotalCharges
    rows = {r["customer_id"]: r for r in df.collect()}
    assert rows[1]["note"] == "two\nlines"
    assert rows[2]["note"] == 'say "hi"'
    out = prepare(df)
    assert sorted(r["customer_id"] for r in out.collect()) == [1, 3]   # blank total -> dropped
    assert dict(out.dtypes)["total"] == "double"


def test_key_violations_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (None, 3.0), (2, 4.0)], "k bigint, x double")
    got = {(r["k"], r["n"]) for r in key_violations(df, ["k"]).collect()}
    assert got == {(1, 2), (None, 1)}
    with pytest.raises(KeyViolation):
        create_feature_table(spark, unique_name("bad_ft"), df, ["k"])
    # a violating rewrite leaves the previous table in place
    name = unique_name("kept_ft")
    create_feature_table(spark, name, df.dropDuplicates(["k"]).where("k IS NOT NULL"), ["k"])
    before = sorted(map(tuple, spark.read.table(name).collect()))
    with pytest.raises(KeyViolation):
        create_feature_table(spark, name, df, ["k"])
    assert sorted(map(tuple, spark.read.table(name).collect())) == before


def _snapshot(spark):
    return spark.createDataFrame(
        [(123, 0.0, 100.0, 50.0, 1000.0), (45678, 1.0, 2000.0, 10.0, 500000.0)],
        "customer_id bigint, senior double, tenure double, monthly double, total double")


def test_text_keys_are_coerced(spark):
    req = spark.createDataFrame([("123",), ("x",), (None,)], "customer_id string") \
               .withColumn("request_key", F.col("customer_id"))
    c = Contract(FSCHEMA, "churn", ("No", "Yes"), tree=fixed_tree())
    out = {r["request_key"]: r for r in score_requests(spark, c, req, _snapshot(spark), "customer_id").collect()}
    assert out["123"]["prediction"] == "Yes"          # total<=300000, tenure<=1800
    assert out["x"]["customer_id"] is None and out["x"]["prediction"] is None


def test_request_lacking_a_field(spark):
    bodies = spark.createDataFrame(
        [('[{"senior": 0, "tenure": 12, "monthly": 65, "total": 800}, '
          '{"senior": 1, "tenure": 24, "monthly": 40}]',)], "body string")
    rows = records_to_rows(bodies, "body", FSCHEMA)
    got = score_columns(rows, fixed_tree()).collect()
    assert got[0]["tenure"] == 12.0 and got[0]["prediction"] == "Yes"
    assert got[1]["total"] is None and got[1]["prediction"] is None


def test_contract_conform(spark):
    c = Contract(FSCHEMA)
    df = spark.createDataFrame([(1, 0, 12, 65, 800, "extra")],
                               "id int, SENIOR int, tenure int, monthly int, total int, z string")
    out = conform(df, c, keep=["id"])
    assert out.columns == ["id", *FEATS]
    assert all(t == "double" for _, t in out.dtypes[1:])
    with pytest.raises(ContractError):
        conform(df.drop("total"), c)


def test_empty_frame_all_paths(spark):
    empty = spark.createDataFrame([], FSCHEMA)
    t = leaf_class_counts(fixed_tree(), spark.createDataFrame([], "senior double, tenure double, "
                                                                "monthly double, total double, churn string"),
                          "churn")
    for df in (score_columns(empty, t), score_struct(empty, t), score_map(empty, t), score_multi(empty, t)):
        assert df.count() == 0


def test_scoring_paths_agree(spark):
    p = common.p(spark, SF_MID).select("customer_id", *FEATS)
    train, _ = hash_split(common.z(spark, SF_MID))
    tree = leaf_class_counts(fixed_tree(), train, "churn")
    a = score_columns(p, tree).select("customer_id", F.col("prediction").alias("a"))
    b = score_struct(p, tree).select("customer_id", F.col("prediction").alias("b"))
    c = score_map(p, tree).select("customer_id", F.col("prediction").alias("c"))
    d = score_multi(p, tree).select("customer_id", F.col("prediction").alias("d"),
                                    F.col("prob_Yes").alias("py"))
    e = p.select("customer_id", multi_udf(tree)(F.struct(*FEATS)).alias("m")) \
         .select("customer_id", F.col("m.prediction").alias("e"), F.col("m.prob_Yes").alias("pe"))
    j = a.join(b, "customer_id").join(c, "customer_id").join(d, "customer_id").join(e, "customer_id")
    rows = j.collect()
    assert len(rows) == 1500
    nulls = 0
    for r in rows:
        assert r["a"] == r["b"] == r["c"] == r["d"] == r["e"]
        assert (r["py"] is None and r["pe"] is None) or abs(r["py"] - r["pe"]) < 1e-12
        nulls += r["a"] is None
    assert nulls == 113  # rows without features score NULL


def test_split_disjoint_complete_and_partition_invariant(spark):
    z = common.z(spark, SF_MID)
    tr, te = hash_split(z)
    a = {r[0] for r in tr.select("customer_id").collect()}
    b = {r[0] for r in te.select("customer_id").collect()}
    assert not (a & b) and len(a | b) == z.count() == 1387
    tr1, _ = hash_split(z.repartition(1))
    tr8, _ = hash_split(z.repartition(8, "churn"))
    assert {r[0] for r in tr1.select("customer_id").collect()} == a == \
           {r[0] for r in tr8.select("customer_id").collect()}


def test_ab_shares_near_half(spark):
    b = common.b(spark, SF_MID).select("customer_id")
    routes = [Route("v1", 50), Route("v2", 50)]
    n = dict(assign(b, "customer_id", routes).groupBy("variant").count().collect())
    share = n["v1"] / (n["v1"] + n["v2"])
    assert abs(share - 0.5) <= 0.03
    # routing salt is independent of the train/test split
    j = assign(b, "customer_id", routes).withColumn("train", hash_bucket("customer_id") < 80)
    cnt = {(r["variant"], r["train"]): r["count"] for r in j.groupBy("variant", "train").count().collect()}
    assert abs(cnt[("v1", True)] / (cnt[("v1", True)] + cnt[("v2", True)]) - 0.5) <= 0.04


def test_latest_per_key_tie_and_null_ts(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00", 10, 1.0), (2, "2024-01-02 00:00:00", 10, 2.0),
         (3, "2024-01-02 00:00:00", 10, 3.0),   # tie on ts: higher event_id wins
         (4, None, 10, 4.0), (5, None, 11, 5.0), (6, "2023-01-01 00:00:00", 11, 6.0),
         (7, None, 12, 7.0), (8, None, 12, 8.0)],  # a key with NULL ts only stays
        "event_id bigint, ts string, user_id bigint, value double") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {r["user_id"]: r["event_id"] for r in latest_per_key(df, "user_id", "ts", "event_id").collect()}
    assert got == {10: 3, 11: 6, 12: 8}
    one = latest_per_key(df.repartition(1), "user_id", "ts", "event_id").collect()
    assert {r["user_id"]: r["event_id"] for r in one} == got


def test_row_position_distributed(spark):
    keys = list(range(0, 5000, 3))
    random.Random(7).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5)
    for buckets in (1, 4, 16):
        got = {r["k"]: r["pos"] for r in row_position(df, "k", "pos", buckets=buckets).collect()}
        assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_skew_safe_lookup_equals_plain_join(spark):
    feats = spark.createDataFrame([(k, float(k)) for k in range(50)], "customer_id bigint, x double")
    name = unique_name("ft_skew")
    create_feature_table(spark, name, feats, ["customer_id"])
    rows = [(i, 7) for i in range(300)] + [(1000 + i, i % 60) for i in range(600)]  # key 7 ~ 1/3
    req = spark.createDataFrame(rows, "o bigint, customer_id bigint")
    got = lookup_skew_safe(spark, req, FeatureLookup.of(name, "customer_id"), fraction=0.1)
    want = req.join(feats, "customer_id", "left")
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.count() == 900


def _gini_brute(xs, ys):
    best = None
    n = len(xs)
    for f in range(xs.shape[1]):
        for t in sorted(set(xs[:, f])):
            left = xs[:, f] <= t
            nl = left.sum()
            if nl == n:
                continue
            yl, yr = ys[left].sum(), ys[~left].sum()
            nr = n - nl
            g = 2.0 * (yl * (nl - yl) / nl + yr * (nr - yr) / nr) / n
            cand = (g, f, t)
            best = cand if best is None or cand < best else best
    return best


def test_best_split_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    xs = np.column_stack([rng.integers(0, 2, 300), rng.integers(0, 40, 300),
                          np.round(rng.normal(50, 10, 300), 1), rng.integers(0, 9, 300)]).astype(float)
    ys = (xs[:, 1] + rng.normal(0, 8, 300) > 25).astype(int)
    df = spark.createDataFrame(
        [tuple(map(float, r)) + ("Yes" if y else "No",) for r, y in zip(xs, ys)],
        "a double, b double, c double, d double, churn string")
    names = ["a", "b", "c", "d"]
    g, f, t = _gini_brute(xs, ys)
    for buckets in (1, 8):
        r = best_split(df, names, "churn", "Yes", buckets=buckets).collect()[0]
        # ties on gini resolve by feature name, then threshold, as in the SQL
        assert (r["gini"], r["f"], r["x"]) == (np.floor(g * 1e6) / 1e6, names[f], t)


def _random_tree(rng, features, depth):
    if depth == 0 or rng.random() < 0.2:
        return Leaf(rng.choice(["No", "Yes"]))
    return Split(rng.choice(features), float(rng.integers(-5, 5)),
                 _random_tree(rng, features, depth - 1), _random_tree(rng, features, depth - 1))


def test_native_expression_equals_numpy_walker(spark):
    rng = np.random.default_rng(11)
    feats = ["a", "b", "c"]
    data = [tuple(float(v) if rng.random() > 0.1 else None for v in rng.integers(-6, 6, 3))
            for _ in range(400)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    for depth in (0, 1, 5, 5, 12):
        tree = TreeSpec(tuple(feats), ("No", "Yes"), _random_tree(rng, feats, depth))
        native = [r["prediction"] for r in predict(df, tree).collect()]
        x = np.array([[np.nan if v is None else v for v in row] for row in data])
        assert list(predict_numpy(tree, x)) == native


def test_native_outputs_of_a_leaf(spark):
    """Leaf number, label and class shares belong together, whatever columns the input has."""
    from churnlane.operators.score import score_multi
    from churnlane.operators.tree import with_leaf_index
    train, test = hash_split(common.z(spark, SF_SMALL))
    tree = leaf_class_counts(fixed_tree(), train, "churn")
    x = test.select("customer_id", *FEATS).withColumns({"_node": F.lit(1), "_x": F.lit(2), "_at": F.lit(3)})
    rows = score_multi(with_leaf_index(x, tree, "leaf"), tree).collect()
    leaves = tree.leaves()
    assert {r["leaf"] for r in rows} - {None}
    for r in rows:
        assert (r["_node"], r["_x"], r["_at"]) == (1, 2, 3)
        if any(r[f] is None for f in FEATS):
            assert (r["leaf"], r["prediction"], r["prob_No"]) == (None, None, None)
        else:
            leaf = leaves[r["leaf"]]
            assert r["prediction"] == leaf.label and [r["prob_No"], r["prob_Yes"]] == [c / sum(leaf.counts) for c in leaf.counts]
    single = TreeSpec(tuple(FEATS), ("No", "Yes"), Leaf("Yes", (1.0, 3.0)))   # depth 0
    assert {r["prediction"] for r in predict(x.na.drop(), single).collect()} == {"Yes"}


@pytest.mark.parametrize("depth", [3, 10, None])
def test_fitted_tree_compiles_to_same_predictions(spark, depth):
    train, test = hash_split(common.z(spark, SF_MID))
    model, classes = fit_tree(train, FEATS, "churn", max_depth=depth, seed=42)
    path = scratch_path(spark, "fit-test")
    model.write().overwrite().save(path)
    tree = from_saved_model(spark, path, FEATS, classes)
    ml = model.transform(test).select("customer_id", F.element_at(
        F.array(*[F.lit(c) for c in classes]), F.col("prediction").cast("int") + 1).alias("ml"))
    nat = predict(test, tree, "nat").select("customer_id", "nat")
    rows = ml.join(nat, "customer_id").collect()
    assert rows and all(r["ml"] == r["nat"] for r in rows)


def test_fit_holdout_accuracy_vs_majority(spark):
    train, test = hash_split(common.z(spark, SF_MID))
    model, classes = fit_tree(train, FEATS, "churn", max_depth=3, seed=42)
    out = model.transform(test).withColumn(
        "pred", F.element_at(F.array(*[F.lit(c) for c in classes]), F.col("prediction").cast("int") + 1))
    n = out.count()
    acc = out.where(F.col("pred") == F.col("churn")).count() / n
    majority = max(r["count"] for r in test.groupBy("churn").count().collect()) / n
    assert acc >= majority - 0.02   # a depth-3 tree on 4 weak features is near the majority rate


def test_single_class_label_fits(spark):
    df = spark.createDataFrame([(float(i % 2), float(i), 1.0, 2.0, "No") for i in range(30)],
                               "senior double, tenure double, monthly double, total double, churn string")
    model, classes = fit_tree(df, FEATS, "churn", max_depth=3)
    assert classes == ("No",)
    assert {r[0] for r in model.transform(df).select("prediction").collect()} == {0.0}


def test_model_store_versions_and_aliases(spark):
    store = ModelStore(spark, scratch_path(spark, "store-test"))
    c = Contract(FSCHEMA, "churn", ("No", "Yes"), tree=fixed_tree())
    for _ in range(10):
        v = store.log_model("m", c)
    assert v == 10 and store.latest_version("m") == 10    # integer compare: 10 > 9
    store.set_alias("m", "Champion", 9)
    assert store.resolve("m@champion").endswith("/m/9")
    assert store.load_contract("m@CHAMPION").tree == fixed_tree()


def test_append_evolve_adds_and_fills(spark):
    name = create_typed_table(spark, unique_name("evolve"), "k BIGINT, churn STRING, p STRING")
    append_evolve(spark, spark.createDataFrame([(1, "Yes")], "k bigint, p string"), name)
    append_evolve(spark, spark.createDataFrame([(2, "No", 2)], "k bigint, p string, v int"), name)
    got = sorted(tuple(r) for r in spark.read.table(name).collect())
    assert spark.read.table(name).columns == ["k", "churn", "p", "v"]
    assert got == [(1, None, "Yes", None), (2, None, "No", 2)]


@pytest.mark.parametrize("compact_every", [1, 2, 8])
def test_stream_latest_survives_restart(spark, compact_every):
    from churnlane.sources.tables import events
    from churnlane.streaming.snapshot import current_snapshot, maintain_latest
    ev = events(spark, SF_SMALL)
    src, root, ckpt = (scratch_path(spark, x) for x in ("ev-src", "ev-root", "ev-ckpt"))
    first = ev.where(hash_bucket("event_id", "half:", 2) == 0)
    second = ev.where(hash_bucket("event_id", "half:", 2) == 1)
    first.repartition(3).write.parquet(f"{src}/a")
    maintain_latest(spark, f"{src}/*", ev.schema, root, ckpt, "user_id", "ts", "event_id",
                    max_files_per_trigger=1, compact_every=compact_every)
    half = latest_per_key(first, "user_id", "ts", "event_id").select("user_id", "event_id")
    assert sorted(map(tuple, current_snapshot(spark, root).select("user_id", "event_id").collect())) \
        == sorted(map(tuple, half.collect()))
    second.repartition(3).write.parquet(f"{src}/b")       # more data arrives, job restarts
    maintain_latest(spark, f"{src}/*", ev.schema, root, ckpt, "user_id", "ts", "event_id",
                    max_files_per_trigger=1, compact_every=compact_every)
    snap = current_snapshot(spark, root)
    got = sorted(tuple(r) for r in snap.select("user_id", "event_id").collect())
    want = sorted(tuple(r) for r in latest_per_key(ev, "user_id", "ts", "event_id")
                  .select("user_id", "event_id").collect())
    assert got == want
    assert snap.count() == snap.select("user_id").distinct().count()


def test_fit_tree_unlimited_native_equals_transform(spark):
    import __spark_entry__ as E
    rows = E.queries()["fit_tree_unlimited"](spark, SF_MID).collect()
    assert len(rows) == 298
    assert all(r["agrees"] for r in rows)


def test_model_round_trip_native_equals_transform(spark):
    import __spark_entry__ as E
    rows = E.queries()["model_round_trip"](spark, SF_MID).collect()
    assert len(rows) == 298
    assert all(r["agrees"] for r in rows)


@pytest.mark.parametrize("name", ["latest_by_key", "row_position", "best_split", "score_multi",
                                  "metrics", "pk_violations", "ab_compare", "column_stats",
                                  "surrogate_id", "stream_latest", "key_lookup", "score_orders",
                                  "clustered_write", "layout_partitioned", "zorder_layout",
                                  "training_set", "score_batch"])
def test_queries_partition_invariant(spark, name):
    import __spark_entry__ as E
    q = E.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = sorted(map(tuple, q(spark, SF_SMALL).collect()), key=repr)
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = sorted(map(tuple, q(spark, SF_SMALL).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == many


def test_score_stream_restart_each_request_once(spark):
    from churnlane.streaming.scoring import request_log, score_stream
    from churnlane.plans.q_features import churn_contract
    z = common.z(spark, SF_SMALL)
    snap = z.select("customer_id", *FEATS)
    keys = common.b(spark, SF_SMALL).select(F.col("customer_id").cast("string").alias("customer_id"))
    src, out, ckpt = (scratch_path(spark, x) for x in ("rq", "rq-out", "rq-ckpt"))
    schema = T.StructType([T.StructField("customer_id", T.StringType())])
    contract = churn_contract(spark, SF_SMALL, "unused")
    keys.where(hash_bucket("customer_id", "h:", 2) == 0).repartition(3).write.parquet(f"{src}/a")
    score_stream(spark, f"{src}/*", schema, snap, contract, "customer_id", out, ckpt, "m-1",
                 max_files_per_trigger=1)
    keys.where(hash_bucket("customer_id", "h:", 2) == 1).repartition(3).write.parquet(f"{src}/b")
    score_stream(spark, f"{src}/*", schema, snap, contract, "customer_id", out, ckpt, "m-1",
                 max_files_per_trigger=1)
    got = spark.read.parquet(out)
    assert got.count() == keys.count() == got.select("request_key").distinct().count()
    assert request_log(got).select("batch_id", "request_id").distinct().count() == keys.count()


def test_surrogate_key_fast_is_unique_and_pinned(spark):
    from churnlane.operators.ordering import surrogate_key
    z = common.z(spark, SF_MID).drop("customer_id")
    s = surrogate_key(z, "uid")
    a = sorted(tuple(r) for r in s.collect())
    assert s.select("uid").distinct().count() == s.count() == 1387
    assert sorted(tuple(r) for r in s.collect()) == a     # same ids on re-read


def test_use_schema_namespaces_tables(spark):
    from churnlane.sources.sinks import use_schema, write_table
    db = unique_name("lesson_db")
    try:
        use_schema(spark, db)
        name = write_table(spark, spark.range(3), "t")
        assert spark.catalog.currentDatabase() == db
        assert spark.read.table(f"{db}.{name}").count() == 3
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_score_batch_with_skew_split_equals_plain(spark):
    from churnlane.operators.score import score_batch
    feats = spark.createDataFrame([(k, 0.0, float(k * 100), 10.0, 1000.0) for k in range(40)],
                                  "customer_id bigint, senior double, tenure double, monthly double, total double")
    name = unique_name("ft_sb")
    create_feature_table(spark, name, feats, ["customer_id"])
    c = Contract(FSCHEMA, "churn", ("No", "Yes"), "string", (FeatureLookup.of(name, "customer_id"),),
                 "customer_id", fixed_tree())
    keys = spark.createDataFrame([(3,)] * 200 + [(k,) for k in range(60)], "customer_id bigint")
    a = sorted(map(tuple, score_batch(spark, c, keys).collect()), key=repr)
    b = sorted(map(tuple, score_batch(spark, c, keys, skew_fraction=0.05).collect()), key=repr)
    assert a == b and len(a) == 260


def test_control_files_round_trip_and_newest(spark):
    from churnlane.sources import control
    root = scratch_path(spark, "ctl")
    assert control.read_text(spark, f"{root}/nothing") is None
    assert control.newest_numbered(spark, root, r"v=(\d+)") is None
    control.write_text(spark, f"{root}/a.json", '{"x": "é"}')
    control.write_text(spark, f"{root}/a.json", '{"x": 2}')           # replaced, not appended
    assert control.read_text(spark, f"{root}/a.json") == '{"x": 2}'
    for v in (1, 10, 9):
        spark.range(2).write.parquet(f"{root}/v={v}")
    spark.range(1).write.parquet(f"{root}/v=11")
    control.write_text(spark, f"{root}/v=12", "not a finished write")  # no _SUCCESS inside
    assert control.newest_numbered(spark, root, r"v=(\d+)", "_SUCCESS") == 11
    # a text "file" written by a Spark job (a directory of parts) reads back too
    spark.createDataFrame([("line",)], "value string").coalesce(1).write.text(f"{root}/t")
    assert control.read_text(spark, f"{root}/t") == "line"


def test_column_stats_exact_on_edge_types(spark):
    import datetime as dt
    from decimal import Decimal
    from churnlane.operators.metrics import column_stats
    big = 2 ** 53
    rows = [(big, 1.5, Decimal("10.10"), "b", dt.date(2020, 1, 2)),
            (big + 1, float("nan"), Decimal("2.25"), "a", None),      # big+1 == big as a double
            (big + 1, None, None, None, dt.date(2019, 5, 6)),
            (None, -0.0, Decimal("10.10"), "b", dt.date(2020, 1, 2)),
            (7, 0.0, Decimal("-3.00"), "b", None)]
    df = spark.createDataFrame(rows, "a bigint, x double, m decimal(10,2), s string, d date")
    got = {r["col_name"]: r for r in column_stats(df).collect()}
    assert (got["a"]["non_null"], got["a"]["num_nulls"], got["a"]["distinct_count"]) == (4, 1, 3)
    assert (got["a"]["min_num"], got["a"]["max_num"]) == (7.0, float(big + 1))
    assert (got["x"]["non_null"], got["x"]["distinct_count"]) == (4, 3)   # nan, 1.5, 0.0 (= -0.0)
    assert (got["m"]["min_num"], got["m"]["max_num"], got["m"]["distinct_count"]) == (-3.0, 10.1, 3)
    assert (got["s"]["min_text"], got["s"]["max_text"], got["s"]["distinct_count"]) == ("a", "b", 2)
    assert (got["d"]["min_text"], got["d"]["max_text"], got["d"]["num_nulls"]) == ("2019-05-06", "2020-01-02", 2)
    empty = {r["col_name"]: r for r in column_stats(df.limit(0)).collect()}
    assert all((r["non_null"], r["num_nulls"], r["distinct_count"]) == (0, 0, 0) for r in empty.values())


def test_score_stream_hot_request_key_split(spark):
    """A third of the requests ask for one key: the split stream equals the plain batch join."""
    from churnlane.streaming.scoring import request_log, score_stream
    from churnlane.plans.q_features import churn_contract
    snap = common.z(spark, SF_SMALL).select("customer_id", *FEATS)
    hot = snap.select("customer_id").first()[0]
    keys = [str(hot)] * 200 + [str(r[0]) for r in snap.select("customer_id").collect()] * 2 + ["x"] * 5
    src, out, ckpt = (scratch_path(spark, x) for x in ("hq", "hq-out", "hq-ckpt"))
    req = spark.createDataFrame([(k,) for k in keys], "customer_id string")
    req.repartition(4).write.parquet(src)
    schema = T.StructType([T.StructField("customer_id", T.StringType())])
    contract = churn_contract(spark, SF_SMALL, "unused")
    score_stream(spark, src, schema, snap, contract, "customer_id", out, ckpt, "m-1",
                 max_files_per_trigger=2, skew_fraction=0.2)
    got = sorted(map(tuple, spark.read.parquet(out).select("request_key", "prediction").collect()), key=repr)
    want = predict(req.withColumn("request_key", F.col("customer_id"))
                   .withColumn("customer_id", F.col("customer_id").try_cast("bigint"))
                   .join(snap, "customer_id", "left"), fixed_tree())
    assert got == sorted(map(tuple, want.select("request_key", "prediction").collect()), key=repr)
    assert request_log(spark.read.parquet(out)).select("batch_id", "request_id").distinct().count() == len(keys)


def test_score_requests_hot_key_split_equals_plain(spark):
    from churnlane.plans.q_features import churn_contract
    snap = common.z(spark, SF_SMALL).select("customer_id", *FEATS)
    hot = str(snap.select("customer_id").first()[0])
    req = spark.createDataFrame([(hot,)] * 300 + [(str(r[0]),) for r in snap.select("customer_id").collect()]
                                + [("x",), (None,)], "customer_id string")
    c = churn_contract(spark, SF_SMALL, "unused")
    a = sorted(map(tuple, score_requests(spark, c, req, snap, "customer_id").collect()), key=repr)
    b = sorted(map(tuple, score_requests(spark, c, req, snap, "customer_id", skew_fraction=0.1).collect()),
               key=repr)
    assert a == b and len(a) == req.count()


def test_random_split_parts_disjoint_and_complete(spark):
    from churnlane.operators.split import random_split
    z = common.z(spark, SF_MID)
    train, test = random_split(z, (0.8, 0.2), 42)
    a = {r[0] for r in train.select("customer_id").collect()}
    b = {r[0] for r in test.select("customer_id").collect()}
    assert not (a & b) and len(a | b) == z.count() == train.count() + test.count()


def test_cluster_conf_bounds_tasks_and_partitions():
    from churnlane.session import cluster_conf
    tb = 1024 ** 4
    c = cluster_conf(100 * tb)
    split, parts = int(c["spark.sql.files.maxPartitionBytes"]), int(c["spark.sql.shuffle.partitions"])
    assert 100 * tb / split <= 200_000 and split <= 1024 ** 3          # <= 200k scan tasks
    assert 4000 <= parts <= 100_000                                    # 25 TB shuffled / 256 MB
    small = cluster_conf(10 * 1024 ** 3)
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 128 * 1024 ** 2
    assert int(small["spark.sql.shuffle.partitions"]) == 4000          # never below the slots


def test_default_buckets_follow_the_shuffle_partitions(spark):
    from churnlane.session import default_buckets
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "100000")
        assert default_buckets(spark) == 100_000
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert default_buckets(spark) == 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_column_stats_keep_large_integers_exact(spark):
    from churnlane.operators.metrics import column_stats
    df = spark.createDataFrame([(9007199254740993, "1.10"), (-9007199254740993, None)], "a bigint, t string") \
              .select("a", F.col("t").cast("decimal(5,2)").alias("d"))
    got = {r["col_name"]: (r["min_exact"], r["max_exact"]) for r in column_stats(df).collect()}
    assert got == {"a": ("-9007199254740993", "9007199254740993"), "d": ("1.10", "1.10")}


def test_stream_follows_snapshot_refresh(spark):
    from churnlane.streaming.scoring import score_stream
    src, out, ckpt, snap = (scratch_path(spark, x) for x in ("fq", "fq-out", "fq-ckpt", "fq-snap"))
    rows = "customer_id bigint, senior double, tenure double, monthly double, total double"
    schema = T.StructType([T.StructField("customer_id", T.StringType())])
    contract = Contract(FSCHEMA, tree=fixed_tree())
    answers = []
    for part, tenure in (("a", 100.0), ("b", 5000.0)):
        spark.createDataFrame([(1, 0.0, tenure, 50.0, 1000.0)], rows).write.mode("overwrite").parquet(snap)
        spark.createDataFrame([("1",), ("1",), ("x",)], "customer_id string").coalesce(1).write.parquet(f"{src}/{part}")
        score_stream(spark, f"{src}/*", schema, lambda: spark.read.parquet(snap), contract, "customer_id", out, ckpt, "m-1")
        got = spark.read.parquet(out).collect()
        answers.append(sorted(str(r["prediction"]) for r in got))
        assert len({(r["batch"], r["request_id"]) for r in got}) == len(got)
        assert {r["request"] for r in got} == {'{"customer_id":"1"}', '{"customer_id":"x"}'}
    assert answers == [["None", "Yes", "Yes"], ["No", "No", "None", "None", "Yes", "Yes"]]


def test_stored_pipeline_without_tree_scores_by_uri(spark):
    rows = spark.createDataFrame([(float(i), float(i % 3), "Yes" if i > 5 else "No") for i in range(12)], "a double, b double, y string")
    model, classes = fit_tree(rows, ["a", "b"], "y", max_depth=2)
    store = ModelStore(spark, scratch_path(spark, "models"))
    store.log_model("opaque", Contract(rows.select("a", "b").schema, "y", classes), model, ["Live"])
    asked = rows.unionByName(spark.createDataFrame([(None, 1.0, "-"), (float("nan"), 1.0, "-")], rows.schema))
    got = score_stored(spark, store, "opaque@live", asked).select("y", "prediction").collect()
    assert all(r["prediction"] == (None if r["y"] == "-" else r["y"]) for r in got)
    with pytest.raises(ContractError):
        store.log_model("user", Contract(rows.schema), user_model=object())


def test_snapshot_and_lookups_take_composite_keys(spark):
    from churnlane.operators.features import point_lookup
    from churnlane.operators.latest import latest_per_key, publish_snapshot
    rows = [(k, g, t, float(10 * k + t)) for k in range(4) for g in ("a", "b") for t in range(3)]
    path = scratch_path(spark, "two-keys")
    publish_snapshot(latest_per_key(spark.createDataFrame(rows, "k long, g string, ts int, senior double"), ["k", "g"], "ts"),
                     path, ["k", "g"])
    snap = spark.read.parquet(path).withColumns({f: F.col("senior") for f in FEATS})
    assert snap.count() == 8 and {r["ts"] for r in snap.collect()} == {2}
    asked = spark.createDataFrame([("1", "a")] * 30 + [("2", "b"), ("x", "b"), (None, "a"), ("3", None)], "k string, g string")
    assert {(r["k"], r["g"]) for r in point_lookup(snap, asked, ["k", "g"]).collect()} == {(1, "a"), (2, "b")}
    contract = Contract(T.StructType([T.StructField(f, T.DoubleType()) for f in FEATS]), tree=fixed_tree())
    plain = score_requests(spark, contract, asked, snap, ["k", "g"])
    split = score_requests(spark, contract, asked, snap, ["k", "g"], skew_fraction=0.2)
    as_rows = lambda d: sorted(map(str, d.select("k", "g", *FEATS, "prediction").collect()))
    assert as_rows(plain) == as_rows(split) and plain.count() == 34
    assert plain.where("prediction is not null").count() == 31


def test_model_store_writers_at_the_same_time(spark):
    from concurrent.futures import ThreadPoolExecutor
    store = ModelStore(spark, scratch_path(spark, "models"))
    contract = Contract(T.StructType([T.StructField("a", T.DoubleType())]))
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda i: store.log_model("m", contract, aliases=[f"Alias{i}"]), range(8)))
    assert sorted(versions) == list(range(1, 9)) and store.latest_version("m") == 8
    assert [store.resolve(f"m@alias{i}") for i in range(8)] == [f"{store.root}/m/{v}" for v in versions]


def test_snapshot_stream_removes_what_folds_replaced(spark):
    from churnlane.sources import control
    from churnlane.streaming.snapshot import current_snapshot, maintain_latest
    src, root, ckpt = (scratch_path(spark, x) for x in ("ret-src", "ret", "ret-ckpt"))
    rows = spark.createDataFrame([(k, g, k * 10 + g) for k in range(3) for g in range(12)], "k long, ts long, v long")
    for g in range(6):
        rows.where(F.col("ts") % 6 == g).coalesce(1).write.parquet(f"{src}/part{g}")
    maintain_latest(spark, f"{src}/*", rows.schema, root, ckpt, "k", "ts", max_files_per_trigger=1, compact_every=1)
    assert len(control.list_numbered(spark, root, r"v=(\d+)")) == 2
    assert len(control.list_numbered(spark, f"{root}/changes", r"batch=(\d+)")) == 1
    assert sorted(map(tuple, current_snapshot(spark, root).collect())) == [(k, 11, k * 10 + 11) for k in range(3)]
