"""Decision trees with exact thresholds, fitted level by level and kept as a table (FIT-1, SCO-1).

``pyspark.ml`` bins a feature into at most ``maxBins`` values and hands the whole
tree to the driver.  Here every distinct value is a candidate and the tree is a
DataFrame of nodes, so neither its size nor the number of values is bounded by
the driver:

* a level is one pass over the rows of its open nodes: rows become
  (node, feature, value, class) records, counted map-side, and the running class
  counts of all (node, feature) groups are taken at once over pinned ranges
  (``running_sums``), so a node or feature with all the rows has no task of its own;
* the best cut of every node is a partial ``max`` over (gain, feature, value);
* rows move to a child by joining the level's splits on the node number; rows
  of finished nodes leave.

The driver sees the class names and, each level, how many nodes were split.

A cut lies halfway between neighbouring values; ``x <= threshold`` goes left.
Of equal gains the first feature, then the smallest threshold wins.  A node is
split only if that raises the sum over children of ``sum(class count ** 2) / n``.

Node numbers: the root is 1, the children of i are 2 i and 2 i + 1, so a long
holds 62 levels.  ``node_table`` turns a saved ``pyspark.ml`` tree into the same form.

Scoring (``score_nodes``) cuts the tree into subtrees of ``levels`` levels, each
packed into one row of arrays, and walks a row through a subtree by one fold;
between subtrees rows are joined on the subtree's root number.  The first
subtree is one row and broadcast; in later joins a hot root (most rows
may go one way) is split by AQE, since the subtree side has one row a root.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlane.operators.running import running_sums
from churnlane.operators.tree import Leaf, Split, TreeSpec, _tree_stage_dir, missing, unused_name
from churnlane.session import staged
from churnlane.sources import control

MAX_LEVELS = 62
#: Nodes of the compiled form: beyond it a tree stays a table.
MAX_COMPILED = 8191

NODE_DDL = "id long, feature int, threshold double, counts array<long>"


def _class_counts(classes: Sequence[str], y: str) -> list[Column]:
    return [F.sum(F.when(F.col(y) == i, 1).otherwise(0)).cast("long").alias(f"c{i}") for i in range(len(classes))]


def _squares(counts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.cast("double") * c.cast("double") for c in counts])


def _total(counts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, counts)


def best_cuts(rows: DataFrame, features: Sequence[str], n_classes: int, ranges: int | None = None) -> DataFrame:
    """(node, feature, threshold) of every node of ``rows`` (node, features, y) that a cut improves."""
    long = rows.select("node", "y", F.posexplode(F.array(*[F.col(f) for f in features])).alias("feature", "x"))
    counted = long.groupBy("node", "feature", "x").agg(*_class_counts(range(n_classes), "y"))
    names = [f"c{i}" for i in range(n_classes)]
    run = running_sums(counted, ["node", "feature"], "x", names, ranges, following="next")
    left = [F.col(f"run_{c}") for c in names]
    every = [F.col(f"all_{c}") for c in names]
    right = [a - b for a, b in zip(every, left)]
    gain = _squares(left) / _total(left) + _squares(right) / _total(right)
    cut = run.filter(F.col("next").isNotNull()).select(
        "node", "feature", "x", ((F.col("x") + F.col("next")) / 2).alias("threshold"), gain.alias("gain"),
        (_squares(every) / _total(every)).alias("whole"))
    best = cut.groupBy("node").agg(F.max(F.struct("gain", -F.col("feature"), -F.col("x"), F.struct("feature", "threshold", "whole").alias("at"))).alias("b"))
    return best.filter("b.gain > b.at.whole").select("node", "b.at.feature", "b.at.threshold")


def fit_exact(df: DataFrame, features: Sequence[str], label: str, max_depth: int | None = 3, ranges: int | None = None,
              broadcast_rows: int = 1_000_000) -> tuple[DataFrame, tuple[str, ...]]:
    """The exact tree of ``df``'s complete rows: its nodes (id, feature, threshold, counts; a leaf has no feature) and the classes."""
    if max_depth is not None and not 0 <= max_depth <= MAX_LEVELS:
        raise ValueError(f"max_depth from 0 to {MAX_LEVELS}; None asks for that limit")
    depth = MAX_LEVELS if max_depth is None else max_depth
    complete = df.filter(~missing(features) & F.col(label).isNotNull())
    classes = tuple(r[0] for r in complete.select(F.col(label).cast("string")).distinct().sort(label).collect())
    spark = df.sparkSession
    if not classes:
        return spark.createDataFrame([], NODE_DDL), classes
    names = F.array(*[F.lit(c) for c in classes])
    rows, path = staged(complete.select(F.lit(1).cast("long").alias("node"), *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)],
                               (F.array_position(names, F.col(label).cast("string")) - 1).cast("int").alias("y")), "tree-rows")
    cols = [f"f{i}" for i in range(len(features))]
    nodes = None
    for level in range(depth + 1):
        sizes = rows.groupBy("node").agg(F.array(*_class_counts(classes, "y")).alias("counts"))
        leaf = F.lit(None).cast("int").alias("feature"), F.lit(None).cast("double").alias("threshold")
        n, old = 0, path
        if level < depth:
            splits, split_path = staged(best_cuts(rows, cols, len(classes), ranges), "tree-splits")
            n = splits.count()
        here = (sizes.join(splits, "node", "left").select(F.col("node").alias("id"), "feature", "threshold", "counts") if n
                else sizes.select(F.col("node").alias("id"), *leaf, "counts"))
        here, _ = staged(here, "tree-nodes")
        nodes = here if nodes is None else nodes.unionByName(here)
        if n:
            step = F.broadcast(splits) if n <= broadcast_rows else splits
            x = F.get(F.array(*[F.col(c) for c in cols]), F.col("feature"))
            rows, path = staged(rows.join(step, "node").select(
                (F.col("node") * 2 + F.when(x > F.col("threshold"), 1).otherwise(0)).alias("node"), *cols, "y"), "tree-rows")
        control.delete(spark, old)                     # the level's rows: read for the last time
        if level < depth:
            control.delete(spark, split_path)
        if not n:
            break
    return nodes, classes


def majority(counts: Column, classes: Sequence[str]) -> Column:
    """The commonest class of a node, the first of equals."""
    return F.get(F.array(*[F.lit(c) for c in classes]), (F.array_position(counts, F.array_max(counts)) - 1).cast("int"))


# -- other forms ---------------------------------------------------------------

def node_table(spark: SparkSession, model_dir: str) -> DataFrame:
    """The nodes of a saved ``pyspark.ml`` tree, numbered as here: joined level by level, nothing collected but counts."""
    saved = spark.read.parquet(f"{_tree_stage_dir(spark, model_dir)}/data").select(
        F.col("id").alias("at"), "leftChild", "rightChild", F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), F.expr("transform(impurityStats, x -> CAST(x AS long))").alias("counts"))
    level = saved.filter("at = 0").withColumn("id", F.lit(1).cast("long"))
    out = None
    for _ in range(MAX_LEVELS + 1):
        level, _ = staged(level, "tree-level")
        inner = F.col("leftChild") >= 0
        here = level.select("id", F.when(inner, F.col("feature")).alias("feature"), F.when(inner, F.col("threshold")).alias("threshold"), "counts")
        out = here if out is None else out.unionByName(here)
        links = level.filter(inner).select(F.explode(F.array(
            F.struct(F.col("leftChild").alias("at"), (F.col("id") * 2).alias("id")),
            F.struct(F.col("rightChild").alias("at"), (F.col("id") * 2 + 1).alias("id")))).alias("c")).select("c.*")
        if links.isEmpty():
            break
        level = saved.join(links, "at")
    return out


def to_spec(nodes: DataFrame, features: Sequence[str], classes: Sequence[str], max_nodes: int = MAX_COMPILED) -> TreeSpec:
    """The compiled form of a small tree; an error beyond ``max_nodes`` nodes, which the driver does not collect."""
    rows = nodes.limit(max_nodes + 1).collect()
    if len(rows) > max_nodes:
        raise ValueError(f"more than {max_nodes} nodes: score them as a table")
    by_id = {r["id"]: r for r in rows}

    def build(i: int):
        r = by_id[i]
        if r["feature"] is None:
            counts = tuple(r["counts"])
            return Leaf(classes[counts.index(max(counts))], tuple(float(c) for c in counts))
        return Split(features[r["feature"]], r["threshold"], build(2 * i), build(2 * i + 1))
    return TreeSpec(tuple(features), tuple(classes), build(1))


# -- scoring by join -----------------------------------------------------------

def _depth(i: Column) -> Column:
    """Level of a node number, from 0."""
    return F.length(F.bin(i)) - 1


def subtrees(nodes: DataFrame, levels: int) -> DataFrame:
    """One row per subtree: root, level, and its nodes in order as arrays: feature, threshold, first (place of the left child; NULL where it is cut off), counts."""
    depth = _depth(F.col("id"))
    root = F.expr(f"shiftright(id, CAST((length(bin(id)) - 1) % {levels} AS INT))")
    rows = nodes.select(root.alias("root"), F.floor(depth / levels).cast("int").alias("level"), "id", "feature", "threshold", "counts")
    packed = rows.groupBy("root", "level").agg(F.sort_array(F.collect_list(F.struct("id", "feature", "threshold", "counts"))).alias("n"))
    place = F.transform("n", lambda x: F.when(x["feature"].isNotNull(), F.nullif(F.array_position("n.id", x["id"] * 2), F.lit(0)) - 1).cast("int"))
    return packed.select("root", "level", F.col("n.id").alias("ids"), F.col("n.feature").alias("feature"),
                         F.col("n.threshold").alias("threshold"), place.alias("first"), F.col("n.counts").alias("counts"))


def score_nodes(df: DataFrame, nodes: DataFrame, features: Sequence[str], classes: Sequence[str], levels: int = 8,
                out: str = "prediction", leaf: str | None = None, shares: str | None = None) -> DataFrame:
    """``df`` with the label of the leaf each row falls into; NULL where a feature is missing.

    ``leaf``: also the leaf's node number, ``shares``: also the shares of its classes as an array.
    """
    if levels < 2:
        raise ValueError("a subtree has two levels at least")
    names = {k: unused_name(df, k) for k in ("_x", "_at", "_id", "_counts")}
    x, at, id_, counts = names.values()
    parts, _ = staged(subtrees(nodes, levels), "tree-parts")
    deepest = parts.agg(F.max("level")).first()[0]
    cols = df.columns
    rows = df.select("*", F.when(~missing(features), F.array(*[F.col(f).cast("double") for f in features])).alias(x),
                     F.lit(1).cast("long").alias(id_), F.lit(None).cast("array<bigint>").alias(counts))
    for level in range((-1 if deepest is None else deepest) + 1):
        here = parts.filter(F.col("level") == level).select(F.col("root").alias(id_), *[F.col(c).alias(f"_s_{c}") for c in ("ids", "feature", "threshold", "first", "counts")])
        # rows at a leaf, or without features, have no subtree to enter: they keep what they have
        todo = F.when(F.col(x).isNotNull() & F.col(counts).isNull(), F.col(id_))
        d = rows.withColumn("_enter", todo).join((F.broadcast(here) if level == 0 else here).withColumnRenamed(id_, "_root"),
                                                 F.col("_enter") == F.col("_root"), "left")
        side = lambda i: F.when(F.get(F.col(x), F.get(F.col("_s_feature"), i)) > F.get(F.col("_s_threshold"), i), 1).otherwise(0)
        d = d.withColumn(at, F.aggregate(F.sequence(F.lit(1), F.lit(levels - 1)), F.lit(0),
                                         lambda i, _: F.coalesce(F.get(F.col("_s_first"), i) + side(i), i)))
        here_at = lambda c: F.get(F.col(f"_s_{c}"), F.col(at))
        right = side(F.col(at))
        inside, ends = F.col("_root").isNotNull(), here_at("feature").isNull()
        rows = d.select(*cols, x, F.when(inside & ends, here_at("ids")).when(inside, here_at("ids") * 2 + right).otherwise(F.col(id_)).alias(id_),
                        F.when(inside & ends, here_at("counts")).otherwise(F.col(counts)).alias(counts))
    extra = {out: majority(F.col(counts), classes)}
    if leaf:
        extra[leaf] = F.when(F.col(counts).isNotNull(), F.col(id_))
    if shares:
        extra[shares] = F.transform(counts, lambda c: c / F.aggregate(counts, F.lit(0).cast("long"), lambda s, v: s + v))
    return rows.withColumns(extra).drop(x, id_, counts)
