"""Exact trees, scoring by join and rank metrics against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlane.operators.exact_tree import NODE_DDL, fit_exact, node_table, score_nodes, to_spec
from churnlane.operators.metrics import rank_metrics
from churnlane.operators.running import running_sums
from churnlane.operators.train import fit_tree
from churnlane.operators.tree import Leaf, Split, TreeSpec, from_saved_model, leaf_node, predict, predict_numpy
from churnlane.session import scratch_path

FEATURES = ["a", "b", "c"]


def slow_tree(x, y, n_classes, depth):
    """Nodes by number: (feature, threshold, counts), every cut tried in the operator's order."""
    out = {}

    def grow(i, rows, left):
        counts = np.bincount(y[rows], minlength=n_classes).astype(float)
        best = None
        for f in range(x.shape[1]) if left else ():
            values = np.unique(x[rows, f])
            for v, w in zip(values, values[1:]):
                at = x[rows, f] <= v
                a, b = (np.bincount(y[rows[m]], minlength=n_classes).astype(float) for m in (at, ~at))
                gain = sum(c * c for c in a) / sum(a) + sum(c * c for c in b) / sum(b)
                if best is None or gain > best[0]:
                    best = (gain, f, (v + w) / 2)
        if best and best[0] > sum(c * c for c in counts) / sum(counts):
            out[i] = (best[1], best[2], counts.astype(int).tolist())
            at = x[rows, best[1]] > best[2]
            grow(2 * i, rows[~at], left - 1)
            grow(2 * i + 1, rows[at], left - 1)
        else:
            out[i] = (None, None, counts.astype(int).tolist())
    if len(y):
        grow(1, np.arange(len(y)), depth)
    return out


def frame(spark, x, y, names=("x", "y", "z")):
    rows = [(*map(float, r), names[k]) for r, k in zip(x, y)]
    return spark.createDataFrame(rows, "a double, b double, c double, label string").repartition(3)


@pytest.mark.parametrize("seed,values,classes,depth", [(1, 4, 2, 3), (2, 50, 3, 4), (3, 2, 2, None), (4, 1, 2, 3), (5, 6, 1, 2)])
def test_exact_tree_brute_force(spark, seed, values, classes, depth):
    r = np.random.default_rng(seed)
    x, y = r.integers(0, values, (80, 3)).astype(float), r.integers(0, classes, 80)
    y = np.searchsorted(np.unique(y), y)
    df = frame(spark, x, y)
    holes = spark.createDataFrame([(None, 1.0, 1.0, "x"), (1.0, float("nan"), 1.0, "y"), (1.0, 1.0, 1.0, None)], df.schema)
    nodes, names = fit_exact(df.unionByName(holes), FEATURES, "label", depth)
    assert {n.id: (n.feature, n.threshold, n.counts) for n in nodes.collect()} == slow_tree(x, y, len(names), 62 if depth is None else depth)


def test_exact_tree_of_nothing(spark):
    empty = spark.createDataFrame([], "a double, b double, c double, label string")
    nodes, classes = fit_exact(empty, FEATURES, "label")
    assert nodes.count() == 0 and classes == ()
    rows = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    assert [r.prediction for r in score_nodes(rows, nodes, FEATURES, classes or ("x",)).collect()] == [None]


@pytest.mark.parametrize("levels", [2, 3, 8])
def test_score_nodes_equals_compiled(spark, levels):
    r = np.random.default_rng(8)
    x, y = r.normal(0, 1, (300, 3)), r.integers(0, 3, 300)
    df = frame(spark, x, y)
    nodes, classes = fit_exact(df, FEATURES, "label", 9)
    asked = frame(spark, r.normal(0, 1, (200, 3)), r.integers(0, 3, 200)).unionByName(
        spark.createDataFrame([(None, 1.0, 1.0, "x"), (1.0, float("nan"), 1.0, "y")], df.schema)).withColumn("_at", F.lit(1)).withColumn("_x", F.lit(2))
    out = score_nodes(asked, nodes, FEATURES, classes, levels=levels, leaf="leaf", shares="shares")
    assert out.columns == [*asked.columns, "prediction", "leaf", "shares"]
    spec = to_spec(nodes, FEATURES, classes)
    rows = predict(out, spec, "compiled").collect()
    assert len(rows) == 202 and all(r.compiled == r.prediction for r in rows)
    assert sum(r.prediction is None for r in rows) == 2 and all((r.leaf is None) == (r.prediction is None) for r in rows)
    assert all(sum(r.shares) == pytest.approx(1) for r in rows if r.shares)
    with pytest.raises(ValueError):
        to_spec(nodes, FEATURES, classes, max_nodes=5)


def test_saved_tree_as_a_table(spark):
    r = np.random.default_rng(9)
    x, y = r.normal(0, 1, (400, 3)), r.integers(0, 2, 400)
    df = frame(spark, x, y)
    model, classes = fit_tree(df, FEATURES, "label", max_depth=6)
    path = scratch_path(spark, "saved")
    model.write().overwrite().save(path)
    spec = from_saved_model(spark, path, FEATURES, classes)
    out = predict(score_nodes(df, node_table(spark, path), FEATURES, classes, levels=3), spec, "compiled").collect()
    assert all(r.compiled == r.prediction for r in out)


def test_a_million_nodes(spark):
    """A full tree of 2^20 - 1 nodes over one feature in [0, 1): the leaf is the value's place; nothing is collected."""
    depth = 19
    ids = spark.range(1, 2 ** (depth + 1))
    level = (F.length(F.bin("id")) - 1).alias("level")
    cut = (F.col("id") - F.pow(F.lit(2.0), F.col("level")) + 0.5) / F.pow(F.lit(2.0), F.col("level"))
    nodes = ids.withColumn("level", level).select(
        "id", F.when(F.col("level") < depth, F.lit(0)).alias("feature"), F.when(F.col("level") < depth, cut).alias("threshold"),
        F.array(F.col("id") % 7 + 1, F.col("id") % 5 + 1).alias("counts"))
    assert [f.simpleString() for f in nodes.schema] == [f.simpleString() for f in spark.createDataFrame([], NODE_DDL).schema]
    rows = spark.range(2000).select(((F.col("id") * 524287 % 1048573) / 1048573.0 + 1e-9).alias("v"))
    # a third of all rows takes one path
    rows = rows.unionByName(spark.range(1000).select(F.lit(0.123456).alias("v")))
    for r in score_nodes(rows, nodes, ["v"], ("x", "y"), levels=10, leaf="leaf").collect():
        assert r.leaf == 2 ** depth + int(r.v * 2 ** depth) and r.prediction == ("x" if r.leaf % 7 >= r.leaf % 5 else "y")


def chain(depth):
    node = Leaf("p")
    for k in range(depth):
        node = Split("abc"[k % 3], k / depth, Leaf("pq"[k % 2]), node)
    return TreeSpec(("a", "b", "c"), ("p", "q"), node)


@pytest.mark.parametrize("depth", [1, 20, 60, 400])
def test_filters_on_predictions_of_deep_trees(spark, depth):
    """A filter is pushed below the projection by copying its expression; the copy must stay small."""
    tree = chain(depth)
    x = np.random.default_rng(1).random((200, 3))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    want = predict_numpy(tree, x)
    out = predict(df, tree).filter("prediction = 'q'").filter("prediction <> 'p'")
    assert out.count() == (want == "q").sum()
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 60_000
    got = df.withColumn("leaf", leaf_node(tree)).filter("leaf >= 0").count()
    assert got == 200


# ---- running sums and ranks -----------------------------------------------------------------------------------------------

def test_running_sums(spark):
    r = random.Random(4)
    rows = list({(r.choice("gggh"), r.randrange(400)): None for _ in range(500)})
    data = [(g, x, r.randrange(9), 1) for g, x in rows]
    df = spark.createDataFrame(data, "g string, x int, v int, w int").repartition(7)
    for ranges in (1, 5, 40):
        got = {(r.g, r.x): r for r in running_sums(df, ["g"], "x", ["v", "w"], ranges, following="next").collect()}
        assert len(got) == len(data)
        for g, x, _, _ in data:
            mine = sorted((a for a in data if a[0] == g), key=lambda a: a[1])
            k = [a[1] for a in mine].index(x)
            row = got[g, x]
            assert (row.run_v, row.run_w, row.all_v, row.all_w) == (sum(a[2] for a in mine[:k + 1]), k + 1, sum(a[2] for a in mine), len(mine))
            assert row.next == (mine[k + 1][1] if k + 1 < len(mine) else None)


@pytest.mark.parametrize("scores", [3, 1000, 1])
def test_rank_metrics(spark, scores):
    r = np.random.default_rng(scores)
    s, y = r.integers(0, scores, 300) / max(scores - 1, 1), r.integers(0, 2, 300)
    rows = [(float(a), "Yes" if b else "No") for a, b in zip(s, y)] + [(None, "Yes"), (float("nan"), "No"), (0.5, None)]
    got = rank_metrics(spark.createDataFrame(rows, "p double, churn string").repartition(4), "churn", "p").first()
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))
    p = np.clip(s, 1e-15, 1 - 1e-15)
    assert (got.n, got.n_pos, got.n_neg) == (300, len(pos), len(neg))
    assert got.auc == pytest.approx(auc, abs=2e-6) and got.log_loss == pytest.approx(-np.where(y == 1, np.log(p), np.log(1 - p)).mean(), abs=2e-6)


def test_rank_metrics_without_a_class(spark):
    one = rank_metrics(spark.createDataFrame([(0.5, "Yes")], "p double, churn string"), "churn", "p").first()
    assert (one.n, one.auc) == (1, None) and one.log_loss == pytest.approx(np.log(2), abs=1e-6)
    none = rank_metrics(spark.createDataFrame([], "p double, churn string"), "churn", "p").first()
    assert (none.n, none.auc, none.log_loss) == (0, None, None)
