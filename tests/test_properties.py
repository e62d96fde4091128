"""Property tests: operators vs brute force on random frames with a hot key and ties."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from churnlane.operators.features import FeatureLookup, create_feature_table, key_violations, lookup_skew_safe
from churnlane.operators.latest import latest_per_key
from churnlane.operators.metrics import classification_metrics
from churnlane.session import unique_name

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

events = st.lists(
    st.tuples(st.sampled_from([0, 0, 0, 1, 2, 3, 4]),          # key 0 holds ~ a third or more
              st.one_of(st.none(), st.integers(0, 5)),         # few distinct ts -> many ties
              st.floats(-10, 10, allow_nan=False)),
    min_size=0, max_size=60)


@SETTINGS
@given(rows=events)
def test_latest_per_key_matches_brute_force(spark, rows):
    data = [(i, k, ts, v) for i, (k, ts, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id bigint, user_id bigint, ts bigint, value double")
    got = {r["user_id"]: (r["event_id"], r["value"])
           for r in latest_per_key(df, "user_id", "ts", "event_id").collect()}
    want = {}
    for i, k, ts, v in data:
        order = (ts is not None, ts or 0, i)
        if k not in want or order > want[k][0]:
            want[k] = (order, (i, v))
    assert got == {k: x[1] for k, x in want.items()}


@SETTINGS
@given(keys=st.lists(st.one_of(st.none(), st.sampled_from([1, 1, 1, 2, 3, 4, 5, 6])), max_size=80))
def test_key_violations_matches_pandas(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = sorted(((r["k"], r["n"]) for r in key_violations(df, ["k"]).collect()), key=repr)
    s = pd.Series(keys, dtype="object")
    counts = s.value_counts(dropna=False)
    want = sorted(((None if (k is None or (isinstance(k, float) and math.isnan(k))) else int(k), int(n))
                   for k, n in counts.items()
                   if n > 1 or k is None or (isinstance(k, float) and math.isnan(k))), key=repr)
    assert got == want


@SETTINGS
@given(req=st.lists(st.sampled_from([7, 7, 7, 7, 1, 2, 3, 99, None]), min_size=1, max_size=80),
       fraction=st.sampled_from([0.05, 0.2, 0.5]))
def test_skew_safe_lookup_matches_join(spark, req, fraction):
    feats = spark.createDataFrame([(k, float(k) / 2) for k in range(10)], "k bigint, x double")
    name = unique_name("ft_prop")
    create_feature_table(spark, name, feats, ["k"])
    df = spark.createDataFrame([(i, k) for i, k in enumerate(req)], "i bigint, k bigint")
    got = sorted(map(tuple, lookup_skew_safe(spark, df, FeatureLookup.of(name, "k"), fraction)
                     .select("i", "k", "x").collect()), key=repr)
    want = sorted(map(tuple, df.join(feats, "k", "left").select("i", "k", "x").collect()), key=repr)
    assert got == want


@SETTINGS
@given(pairs=st.lists(st.tuples(st.sampled_from(["No", "Yes"]), st.sampled_from(["No", "Yes", None])),
                      min_size=1, max_size=50))
def test_metrics_match_brute_force(spark, pairs):
    df = spark.createDataFrame(pairs, "churn string, prediction string")
    r = classification_metrics(df, "churn").collect()[0]
    n = len(pairs)
    ok = sum(1 for y, p in pairs if p is not None and y == p)
    tp = sum(1 for y, p in pairs if y == "Yes" and p == "Yes")
    pp = sum(1 for _, p in pairs if p == "Yes")
    ap = sum(1 for y, _ in pairs if y == "Yes")
    f = lambda a, b: None if b == 0 else math.floor(a / b * 1e6) / 1e6
    assert (r["n"], r["ok"], r["tp"], r["pred_pos"], r["act_pos"]) == (n, ok, tp, pp, ap)
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (f(ok, n), f(tp, pp), f(tp, ap),
                                                                     f(2 * tp, pp + ap))


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.sampled_from([5, 5, 5, 5, 1, 2, 9])),
                               st.integers(0, 2)), max_size=80),
       buckets=st.sampled_from([1, 3, 8]))
def test_row_position_matches_sorted_enumeration(spark, rows, buckets):
    """Hot key 5, many exact copies, NULL keys (last): positions are 0..n-1 in (key, t) order."""
    from churnlane.operators.ordering import row_position
    df = spark.createDataFrame(rows, "k bigint, t int").repartition(4)
    got = sorted(((r["pos"], r["k"], r["t"]) for r in
                  row_position(df, "k", "pos", tie_break=["t"], buckets=buckets).collect()))
    want = sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    assert [g[0] for g in got] == list(range(len(rows)))
    assert [(g[1], g[2]) for g in got] == want


@SETTINGS
@given(req=st.lists(st.sampled_from(["7", "7", "7", "7", "1", "3", "x", "99", None]), max_size=60))
def test_point_lookup_matches_brute_force(spark, req):
    """Text request keys with a hot key, junk and NULLs: each matching feature row once."""
    from churnlane.operators.features import point_lookup
    feats = spark.createDataFrame([(k, float(k)) for k in range(10)], "k bigint, x double")
    df = spark.createDataFrame([(r,) for r in req], "k string")
    got = sorted(tuple(r) for r in point_lookup(feats, df, "k").collect())
    wanted = {int(r) for r in req if r is not None and r.isdigit() and int(r) < 10}
    assert got == sorted((k, float(k)) for k in wanted)


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.sampled_from([3, 3, 3, 1, -2, 2 ** 40])),
                               st.one_of(st.none(), st.sampled_from([0.5, 0.5, -1.0, float("nan")])),
                               st.one_of(st.none(), st.sampled_from(["b", "b", "a", "", "zz"]))),
                     max_size=50))
def test_column_stats_matches_brute_force(spark, rows):
    from churnlane.operators.metrics import column_stats
    df = spark.createDataFrame(rows, "i bigint, d double, s string")
    got = {r["col_name"]: r for r in column_stats(df).collect()}
    for j, c in enumerate(["i", "d", "s"]):
        vals = [r[j] for r in rows if r[j] is not None]
        keyed = {("nan" if isinstance(v, float) and math.isnan(v) else v) for v in vals}
        g = got[c]
        assert (g["non_null"], g["num_nulls"], g["distinct_count"]) == (len(vals), len(rows) - len(vals), len(keyed))
        if c == "s":
            assert (g["min_text"], g["max_text"]) == ((min(vals), max(vals)) if vals else (None, None))
        elif vals:
            # Spark orders NaN above every number
            order = sorted(vals, key=lambda v: (isinstance(v, float) and math.isnan(v), v))
            lo, hi = float(order[0]), float(order[-1])
            assert (g["min_num"] == lo or (math.isnan(lo) and math.isnan(g["min_num"])))
            assert (g["max_num"] == hi or (math.isnan(hi) and math.isnan(g["max_num"])))


@settings(max_examples=3, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(rows=st.lists(st.tuples(st.sampled_from([0, 0, 0, 1, 2]), st.integers(0, 4)), min_size=1, max_size=40),
       files=st.integers(1, 5), every=st.sampled_from([1, 2, 3]))
def test_stream_snapshot_matches_batch_latest(spark, rows, files, every):
    """Random events in 1..5 files, one file per micro-batch, folds every 1..3 batches."""
    from churnlane.session import scratch_path
    from churnlane.streaming.snapshot import current_snapshot, maintain_latest
    data = [(i, k, ts) for i, (k, ts) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id bigint, user_id bigint, ts bigint")
    src, root, ckpt = (scratch_path(spark, x) for x in ("p-src", "p-root", "p-ckpt"))
    df.repartition(files).write.parquet(src)
    maintain_latest(spark, src, df.schema, root, ckpt, "user_id", "ts", "event_id",
                    max_files_per_trigger=1, compact_every=every)
    got = sorted(tuple(r) for r in current_snapshot(spark, root).select("user_id", "event_id").collect())
    want = {}
    for i, k, ts in data:
        if k not in want or (ts, i) > want[k][0]:
            want[k] = ((ts, i), i)
    assert got == sorted((k, v[1]) for k, v in want.items())


@SETTINGS
@given(keys=st.lists(st.one_of(st.none(), st.sampled_from([7, 7, 7, 1, 2, 3, 4, 5, 6, 8, 9])), max_size=120),
       fraction=st.sampled_from([0.05, 0.1, 0.3]))
def test_hot_keys_match_exact_counts(spark, keys, fraction):
    from churnlane.operators.features import hot_keys
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    threshold = max(1, int(len(keys) * fraction))
    want = sorted({k for k in keys if k is not None and keys.count(k) > threshold})
    assert sorted(hot_keys(df, "k", fraction)) == want
