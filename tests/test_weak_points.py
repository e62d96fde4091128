"""Strict contracts, lookup keys, request logs, table swaps, composite and repeated stream requests, refreshed layers, sketches, layouts."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.operators.contract import Contract, conform
from churnlane.operators.curves import MAX_DIMENSIONS, hilbert, hilbert_index, state_table
from churnlane.operators.features import FeatureLookup, KeyViolation, create_feature_table, join_hot_split, lookup
from churnlane.operators.layout import clustered, file_ranges, write_clustered
from churnlane.operators.sketches import SketchLog, merge_sketches, read_sketches, sketch_columns
from churnlane.operators.tree import Leaf, Split, TreeSpec
from churnlane.operators.upkeep import JOURNAL, FileFacts, choose, compact_files, file_facts
from churnlane.plans.refresh import Dataset, Refresher
from churnlane.session import scratch_path, unique_name
from churnlane.sources import control
from churnlane.sources.sinks import capture_frame, create_typed_table, location_of, materialize, sent
from churnlane.streaming.scoring import score_stream

R = random.Random(3)


# ---- contract -----------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("ddl,value,target,want", [
    ("x double", 2.0, "int", 2), ("x double", 2.7, "int", "error"), ("x double", 3e12, "int", "error"), ("x double", float("nan"), "int", "error"),
    ("x long", 2**40, "int", "error"), ("x long", 7, "double", 7.0), ("x long", 2**53 + 1, "double", "error"), ("x double", 0.1, "float", 0.1),
    ("x double", 1e300, "float", "error"), ("x double", float("inf"), "float", float("inf")), ("x string", "7", "int", 7), ("x string", "7.5", "int", "error"),
    ("x string", "", "double", "error"), ("x int", None, "double", None), ("x decimal(10,2)", "1.50", "int", "error"), ("x decimal(10,2)", "3.00", "int", 3),
    ("x boolean", True, "int", 1)])
def test_conform_keeps_values(spark, ddl, value, target, want):
    from decimal import Decimal
    value = Decimal(value) if "decimal" in ddl else value
    df = spark.createDataFrame([(value,)], ddl)
    contract = Contract(T.StructType.fromDDL(f"x {target}"))
    loose = conform(df, contract, strict=False).first().x
    if want == "error":
        assert loose is None
        with pytest.raises(PySparkException):
            conform(df, contract).collect()
    else:
        got = conform(df, contract).first().x
        assert got == loose and (got == pytest.approx(want) if want is not None else got is None)


# ---- lookups ------------------------------------------------------------------------------------------------------------

def test_lookup_by_part_of_the_key_is_an_error(spark):
    name = unique_name("pairs")
    create_feature_table(spark, name, spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], "k long, part string, v double"), ["k", "part"])
    asked = spark.createDataFrame([(1, "b")], "k long, part string")
    with pytest.raises(KeyViolation):
        lookup(spark, asked, [FeatureLookup.of(name, "k")])
    assert [tuple(r) for r in lookup(spark, asked, [FeatureLookup.of(name, ["K", "part"])]).collect()] == [(1, "b", 2.0)]


def test_hot_split_runs_its_input_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def noted(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b
    asked = spark.range(3000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k")).mapInArrow(noted, "k long")
    feats = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = join_hot_split(asked, feats, "k", 0.1)
    assert out.filter("v = 2 * k").count() == 3000 and runs.value == 3000


# ---- request log and tables ---------------------------------------------------------------------------------------------

def test_log_has_what_was_sent(spark):
    asked = spark.createDataFrame([("1", None), ("1", "x"), ("y", "x")], "k string, note string")
    scored = sent(asked).withColumn("k", F.col("k").try_cast("long")).withColumn("v", F.lit(3.0)).withColumn("prediction", F.lit("p"))
    log = capture_frame(scored, ["prediction"], "m-1", batch_id=4).collect()
    assert len({r.request_id for r in log}) == 3 and all(r.request_id.startswith("4-") for r in log)
    assert sorted(r.request for r in log) == sorted(['{"k":"1","note":null}', '{"k":"1","note":"x"}', '{"k":"y","note":"x"}'])


def test_a_dataset_is_swapped_in_place(spark):
    name = unique_name("swapped")
    materialize(spark, name, spark.range(5).toDF("a"), "first", {"quality": "x"})
    first, held = location_of(spark, name), spark.read.table(name)
    materialize(spark, name, spark.range(9).toDF("a"), "second", {"quality": "y"})
    assert spark.read.table(name).count() == 9 and location_of(spark, name) != first
    assert spark.read.parquet(first).count() == 5 and held.schema == spark.read.table(name).schema
    assert {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}["quality"] == "y"
    materialize(spark, name, spark.range(2).select(F.col("id").alias("b"), F.lit("t").alias("c")))        # other columns: replaced whole
    assert spark.read.table(name).columns == ["b", "c"]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(f"{name}_staging")]


# ---- streams ------------------------------------------------------------------------------------------------------------

TREE = TreeSpec(("v",), ("lo", "hi"), Split("v", 2.0, Leaf("lo"), Leaf("hi")))
CONTRACT = Contract(T.StructType().add("v", "double"), tree=TREE)


def test_stream_by_two_keys_and_sent_again(spark):
    feats = spark.createDataFrame([(1, "a", 1.0), (1, "b", 3.0), (2, "a", None)], "k long, part string, v double")
    path, out, ckpt = (scratch_path(spark, n) for n in ("req", "out", "ckpt"))
    schema = "client string, at timestamp, k string, part string"

    def send(rows):
        spark.createDataFrame(rows, "client string, at string, k string, part string").withColumn("at", F.to_timestamp("at")).write.mode("append").parquet(path)
        score_stream(spark, path, schema, feats, CONTRACT, ["k", "part"], out, ckpt, "m", keep=["client"], client_id="client", sent_at="at", resent_within="1 hour")
        return sorted((r.client or "", r.k, r.part, r.prediction) for r in spark.read.parquet(out).collect())
    first = send([("c1", "2024-01-01 10:00:00", "1", "a"), ("c1", "2024-01-01 10:01:00", "1", "a"), ("c2", "2024-01-01 10:02:00", "1", "b"),
                  (None, "2024-01-01 10:02:00", "x", "b"), (None, "2024-01-01 10:02:00", "x", "b")])
    assert first == [("", None, "b", None), ("", None, "b", None), ("c1", 1, "a", "lo"), ("c2", 1, "b", "hi")]
    # after a restart, in a later micro-batch: sent again within the hour, and a new one
    second = send([("c2", "2024-01-01 10:40:00", "1", "b"), ("c3", "2024-01-01 10:41:00", "2", "a")])
    assert second == sorted([*first, ("c3", 2, "a", None)])
    keys = [r.request_key for r in spark.read.parquet(out).collect()]
    assert '{"k":"1","part":"a"}' in keys


# ---- refreshed layers ---------------------------------------------------------------------------------------------------

def test_only_changed_inputs_are_refreshed(spark):
    src, root = scratch_path(spark, "src"), scratch_path(spark, "flow")

    def flow(version="1"):
        return Refresher(spark, root, [
            Dataset("raw", path=f"{src}/*", read=lambda s, files: s.read.schema("a long").parquet(*files)),
            Dataset("double", ("raw",), lambda s, up: s.read.table(up["raw"]).select("a", (F.col("a") * 2).alias("b")), row_wise=True, definition=version),
            Dataset("total", ("double",), lambda s, up: s.read.table(up["double"]).agg(F.sum("b").alias("t")))])

    def files():
        return {p: s for d in ("raw", "double", "total") for p, s in control.file_states(spark, f"{root}/{d}/*").items()}
    spark.range(10).toDF("a").coalesce(1).write.parquet(f"{src}/p1")
    assert flow().refresh() == dict.fromkeys(("raw", "double", "total"), "rebuilt")
    before = files()
    assert flow().refresh() == dict.fromkeys(("raw", "double", "total"), "kept") and files() == before
    spark.range(10, 15).toDF("a").coalesce(1).write.parquet(f"{src}/p2")
    assert flow().refresh() == {"raw": "appended", "double": "appended", "total": "rebuilt"}
    assert {r.run: r.n for r in flow().read("double").groupBy("run").agg(F.count("*").alias("n")).collect()} == {1: 10, 2: 5}
    assert [r.t for r in flow().read("total").collect()] == [sum(range(15)) * 2]
    assert before.items() <= files().items() | {(p, s) for p, s in before.items() if "/total/" in p}
    assert flow("2").refresh() == {"raw": "kept", "double": "rebuilt", "total": "rebuilt"}
    assert flow("2").read("double").count() == 15
    path = next(iter(control.file_states(spark, f"{src}/p2")))
    control.delete(spark, path)
    assert flow("2").refresh() == dict.fromkeys(("raw", "double", "total"), "rebuilt") and flow("2").read("double").count() == 10
    with pytest.raises(ValueError):
        Refresher(spark, root, [Dataset("a", ("b",)), Dataset("b", path="x")])


# ---- sketches -----------------------------------------------------------------------------------------------------------

def test_sketches_merge(spark):
    rows = spark.range(40000).select(
        (F.col("id") % 5000).alias("i"), (F.sqrt(F.col("id").cast("double"))).alias("d"), F.concat(F.lit("t"), F.col("id") % 7).alias("s"),
        F.when(F.col("id") % 4 == 0, F.col("id")).alias("h"), F.lit(None).cast("double").alias("none"), F.current_date().alias("day"))
    parts = [sketch_columns(rows.filter(F.pmod(F.xxhash64("i", "d"), F.lit(5)) == k)) for k in range(5)]
    parts = [spark.createDataFrame(p.collect(), p.schema) for p in parts]
    union = lambda ps: ps[0] if len(ps) == 1 else ps[0].unionByName(union(ps[1:]))
    stats = lambda df: {r.col_name: r for r in read_sketches(df).collect()}
    one, other = stats(merge_sketches(union(parts))), stats(merge_sketches(union([merge_sketches(union(parts[3:])), *parts[:3]])))
    exact = {"i": 5000, "d": 40000, "s": 7, "h": 10000, "none": 0, "day": 1}
    for c, n in exact.items():
        r = one[c]
        assert (r.n, r.nulls) == (40000, {"h": 30000, "none": 40000}.get(c, 0)) and r.distinct_estimate == other[c].distinct_estimate
        assert abs(r.distinct_estimate - n) <= max(1, 0.065 * n)
    assert (one["i"].min_num, one["i"].max_num, one["s"].min_text, one["s"].max_text) == (0, 4999, "t0", "t6")
    for c, q in (("i", [1250, 2500, 3750]), ("d", [100, 141.4, 173.2])):
        width = 5000 if c == "i" else 200
        assert all(abs(a - b) < 0.04 * width for a, b in zip(one[c].quantiles, q))
    assert one["none"].quantiles is None and one["day"].quantiles is None


def test_sketch_log_replaces_a_batch(spark):
    log = SketchLog(spark, scratch_path(spark, "sketches"))
    with pytest.raises(ValueError):
        log.stats()
    log.add(spark.range(10).toDF("a"), 0)
    log.add(spark.range(100).toDF("a"), 1)
    log.add(spark.range(10, 20).toDF("a"), 1)
    r = log.stats().first()
    assert (r.n, r.min_num, r.max_num, r.distinct_estimate) == (20, 0, 19, 20)


# ---- layouts ------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("n,bits", [(1, 5), (2, 4), (3, 3), (4, 2), (5, 2)])
def test_hilbert_curve_is_one(spark, n, bits):
    """Every cell once, and each step of the curve moves to a neighbour along one axis."""
    side = 1 << bits
    cells = spark.range(side ** n).select(*[(F.floor(F.col("id") / side ** k) % side).cast("int").alias(f"c{k}") for k in range(n)])
    rows = cells.withColumn("h", hilbert_index([F.col(f"c{k}") for k in range(n)], bits)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(side ** n))
    assert all(sum(abs(x - y) for x, y in zip(a[:n], b[:n])) == 1 for a, b in zip(rows, rows[1:]))
    digit, after = state_table(n)
    assert max(after) * (1 << n) < len(digit)
    with pytest.raises(ValueError):
        hilbert_index([F.lit(1)] * (MAX_DIMENSIONS + 1), 4)


def test_hilbert_files_are_narrow_in_both_columns(spark):
    df = spark.range(20000).select(F.rand(1).alias("a"), F.rand(2).alias("b"), F.col("id"))
    df = df.unionByName(spark.createDataFrame([(None, 1.0, -1), (float("nan"), 2.0, -2), (0.5, None, -3)], "a double, b double, id long"))

    def spread(frame, c):
        path = scratch_path(spark, "layout")
        frame.write.parquet(path)
        whole = spark.read.parquet(path)
        assert whole.count() == 20003
        return file_ranges(whole.filter("id >= 0"), c).agg(F.avg(F.col("max_value") - F.col("min_value"))).first()[0]
    along = {c: spread(hilbert(df, ["a", "b"], 16, bits=6), c) for c in "ab"}
    sorted_ = {c: spread(clustered(df, ["a", "b"], 16), c) for c in "ab"}
    assert along["a"] < 0.4 and along["b"] < 0.4 and sorted_["b"] > 0.95


def test_files_to_rewrite():
    f = lambda name, size, low, high: FileFacts(name, size, 1, low, high)
    names = lambda groups: [[x.path for x in g] for g in groups]
    good = [f("a", 100, 0, 9), f("b", 100, 10, 19), f("c", 100, 20, 29)]
    assert choose(good, 100) == [] and choose([], 100) == []
    assert names(choose([*good, f("s", 5, 1, 2), f("t", 5, 25, 26)], 100)) == [["s", "t"]]
    assert names(choose([*good, f("s", 5, 1, 2)], 100)) == []
    assert names(choose([f("a", 100, 0, 50), f("b", 100, 10, 60), f("c", 100, 20, 70), f("d", 100, 71, 80)], 100)) == [["a", "b", "c"]]
    assert names(choose([f("x", 5, None, None), f("y", 5, None, None), *good], 100)) == [["x", "y"]]
    many = [f(f"s{k:02d}", 30, k, k) for k in range(10)]
    assert all(sum(x.size for x in g) <= 100 for g in choose(many, 100)) and sum(map(len, choose(many, 100))) == 9


def test_compaction_leaves_good_files(spark):
    name = create_typed_table(spark, unique_name("upkeep"), "k long, v string", ["k"])
    rows = lambda a, b: spark.range(a, b).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    write_clustered(spark, rows(0, 20000), name, ["k"], 5)
    good = {f.path: f.size for f in file_facts(spark.read.table(name), "k")}
    write_clustered(spark, rows(20000, 20400), name, ["k"], 6)
    target = int(1.5 * min(good.values()))
    did = compact_files(spark, name, target_bytes=target)
    after = {f.path: f for f in file_facts(spark.read.table(name), "k")}
    assert did == {"rewritten": 6, "written": 1, "left": 5} and set(good) < set(after) and len(after) == 6
    assert spark.read.table(name).agg(F.count("*"), F.countDistinct("k")).first()[:] == (20400, 20400)
    assert compact_files(spark, name, target_bytes=target) == {"rewritten": 0, "written": 0, "left": 6}
    # overlapping full files: only their stretch is laid out again
    write_clustered(spark, rows(0, 4000), name, ["k"], 1)
    write_clustered(spark, rows(0, 4000), name, ["k"], 1)
    did = compact_files(spark, name, target_bytes=target)
    assert did["rewritten"] in (3, 4) and did["left"] >= 4 and spark.read.table(name).count() == 28400      # the two, and what they overlap
    assert not control.read_text(spark, f"{location_of(spark, name)}/{JOURNAL}")


def test_an_interrupted_exchange_is_finished(spark):
    name = create_typed_table(spark, unique_name("upkeep"), "k long", ["k"])
    write_clustered(spark, spark.range(100).toDF("k"), name, ["k"], 4)
    folder, staging = location_of(spark, name), scratch_path(spark, "staging")
    old = [f.path for f in file_facts(spark.read.table(name), "k")]
    spark.range(100).toDF("k").coalesce(1).write.parquet(staging)
    new = [[p, f"{folder}/whole-{k}.parquet"] for k, p in enumerate(control.list_files(spark, staging, ".parquet"))]
    import json
    control.write_text(spark, f"{folder}/{JOURNAL}", json.dumps({"old": old, "new": new}))
    control.delete(spark, old[0])                                # as far as the lost driver came
    compact_files(spark, name, target_bytes=1)
    assert spark.read.table(name).count() == 100 and [f.path for f in file_facts(spark.read.table(name), "k")] != old


# ---- keyed state --------------------------------------------------------------------------------------------------------

def test_state_puts_out_changed_rows_only(spark):
    from churnlane.operators.latest import latest_per_key
    from churnlane.streaming.keyed import merged_changes, newest_changes
    src, out, ckpt = (scratch_path(spark, n) for n in ("ev", "changes", "ckpt"))
    schema = T.StructType().add("k", "long").add("ts", "timestamp_ntz").add("n", "long").add("v", "string")
    stamp = lambda s: F.to_timestamp_ntz(F.lit(s), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))
    seen = []

    def send(rows):
        df = None
        for k, ts, n, v in rows:
            one = spark.range(1).select(F.lit(k).cast("long").alias("k"), (stamp(ts) if ts else F.lit(None).cast("timestamp_ntz")).alias("ts"),
                                        F.lit(n).cast("long").alias("n"), F.lit(v).alias("v"))
            df = one if df is None else df.unionByName(one)
        df.write.mode("append").parquet(src)
        seen.append(df)
        newest_changes(spark, src, schema, out, ckpt, "k", "ts", "n")
        last = max(control.list_numbered(spark, out, r"batch=(\d+)", "_SUCCESS"))
        return sorted((r.k is None, r.k or 0, r.v) for r in spark.read.parquet(f"{out}/batch={last}").collect())
    big = 2**53 + 1
    assert send([(1, "2024-01-01 00:00:00.000001", 1, "a"), (1, "2024-01-01 00:00:00.000002", 1, "b"), (2, None, 5, "c"), (big, "2024-01-01 00:00:00.000000", -3, "d"),
                 (None, "2024-01-01 00:00:00.000000", 1, "e")]) == [(False, 1, "b"), (False, 2, "c"), (False, big, "d"), (True, 0, "e")]
    # after a restart: a late row, a repeated row, a tie broken upwards, a first time stamp
    assert send([(1, "2023-01-01 00:00:00.000000", 9, "x"), (1, "2024-01-01 00:00:00.000002", 1, "b"), (big, "2024-01-01 00:00:00.000000", 2, "y"),
                 (2, "1969-01-01 00:00:00.000000", 1, "z")]) == [(False, 2, "z"), (False, big, "y")]
    want = latest_per_key(seen[0].unionByName(seen[1]), "k", "ts", "n")
    key = lambda df: sorted(map(tuple, df.select("k", "ts", "n", "v").collect()), key=repr)
    assert key(merged_changes(spark, out, "k", "ts", "n")) == key(want)


# ---- pushed lookups -----------------------------------------------------------------------------------------------------

def rows_read(df):
    """The rows that the scans of a collected frame gave."""
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return found


def test_pushed_lookups_skip_row_groups(spark):
    from churnlane.operators.features import point_lookup
    from churnlane.operators.latest import publish_snapshot
    feats = spark.range(80000).select((F.col("id") * 3).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    read = {}
    for bloom in (False, True):
        path = scratch_path(spark, "snapshot")
        publish_snapshot(feats, path, "k", buckets=16, bloom=bloom)
        table_ = spark.read.parquet(path)
        for name, asked, push in (("one", ["300"], 50), ("none", ["301", "x", None], 50), ("many", [str(3 * i) for i in range(0, 4000, 100)], 50),
                                  ("joined", [str(3 * i) for i in range(0, 4000, 10)], 50), ("empty", [], 50)):
            df = point_lookup(table_, spark.createDataFrame([(a,) for a in asked + asked], "k string"), "k", push=push)
            got = sorted(r.k for r in df.collect())
            assert got == sorted({int(a) for a in asked if a and a.isdigit() and int(a) % 3 == 0})
            read[name, bloom] = rows_read(df)
    assert read["one", True] <= 80000 / 16 * 1.2 < 80000 / 2 < read["one", False]
    assert read["none", True] <= 80000 / 16 * 3 and read["empty", True] == 0


def test_small_micro_batches_read_parts_of_the_snapshot(spark):
    from churnlane.operators.latest import publish_snapshot
    path, req = scratch_path(spark, "snapshot"), scratch_path(spark, "req")
    publish_snapshot(spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 5).cast("double").alias("v")), path, "k", buckets=4)
    spark.createDataFrame([("7",), ("7",), ("9999",), ("x",), (None,)], "k string").write.parquet(req)
    got = {}
    for push in (0, 2, 50):
        out = scratch_path(spark, "out")
        score_stream(spark, req, "k string", lambda: spark.read.parquet(path), CONTRACT, "k", out, scratch_path(spark, "ckpt"), "m", push_keys=push)
        got[push] = sorted(((r.request_key or "", r.k or -1, r.prediction or "") for r in spark.read.parquet(out).collect()))
    assert got[0] == got[2] == got[50] == [("", -1, ""), ("7", 7, "lo"), ("7", 7, "lo"), ("9999", 9999, ""), ("x", -1, "")]
