"""Decision trees as data, compiled to native Spark expressions.

A fitted ``pyspark.ml`` tree is read from its *saved* node table (the
``data/`` parquet that ``model.write().save()`` produces: id, prediction,
impurityStats, leftChild, rightChild, split).  The node list is the model
itself (at most ``2^(depth+1)`` rows; a tree without a depth limit grows with
its training rows: ``exact_tree`` keeps such a tree as a table).

``predict`` scores a tree with one expression, no Python worker.  A small tree
(``CASE_NODES``) is a nested ``CASE WHEN``.  A larger one is literal arrays of
nodes and one fold over the levels that moves a row from its node to a child,
whose size does not depend on the tree.  Either is safe to filter on: the
optimizer pushes a filter below the projection by copying the expression, which
for a chain of one projection a level would triple at each.
Spark trees go left on ``x <= threshold``; a NULL or NaN feature yields a NULL
prediction, on this path as on every other.

``predict_numpy`` evaluates the same spec on numpy arrays for the Arrow
(pandas UDF / mapInPandas) paths used with opaque models.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlane.functions.columns import array_literal


@dataclass(frozen=True)
class Leaf:
    label: str
    counts: tuple[float, ...] | None = None   # class counts in ``classes`` order


@dataclass(frozen=True)
class Split:
    feature: str
    threshold: float
    left: "Leaf | Split"
    right: "Leaf | Split"


Node = Leaf | Split


@dataclass(frozen=True)
class TreeSpec:
    features: tuple[str, ...]
    classes: tuple[str, ...]
    root: Node
    meta: dict = field(default_factory=dict, compare=False)

    # -- structure -------------------------------------------------------
    def leaves(self) -> list[Leaf]:
        out: list[Leaf] = []

        def walk(n: Node) -> None:
            if isinstance(n, Leaf):
                out.append(n)
            else:
                walk(n.left)
                walk(n.right)
        walk(self.root)
        return out

    def used_features(self) -> list[str]:
        seen: list[str] = []

        def walk(n: Node) -> None:
            if isinstance(n, Split):
                if n.feature not in seen:
                    seen.append(n.feature)
                walk(n.left)
                walk(n.right)
        walk(self.root)
        return seen

    def depth(self) -> int:
        def d(n: Node) -> int:
            return 0 if isinstance(n, Leaf) else 1 + max(d(n.left), d(n.right))
        return d(self.root)

    def with_counts(self, counts: dict[int, Sequence[float]]) -> "TreeSpec":
        """Copy with leaf class counts replaced (leaf index -> counts)."""
        it = iter(range(10 ** 9))

        def walk(n: Node) -> Node:
            if isinstance(n, Leaf):
                i = next(it)
                c = counts.get(i)
                return Leaf(n.label, tuple(float(x) for x in c) if c is not None else None)
            return Split(n.feature, n.threshold, walk(n.left), walk(n.right))
        return TreeSpec(self.features, self.classes, walk(self.root), dict(self.meta))

    # -- (de)serialisation ----------------------------------------------
    def to_json(self) -> str:
        def enc(n: Node) -> dict:
            if isinstance(n, Leaf):
                return {"label": n.label, "counts": list(n.counts) if n.counts else None}
            return {"feature": n.feature, "threshold": n.threshold,
                    "left": enc(n.left), "right": enc(n.right)}
        return json.dumps({"features": list(self.features), "classes": list(self.classes),
                           "root": enc(self.root), "meta": self.meta})

    @staticmethod
    def from_json(text: str) -> "TreeSpec":
        d = json.loads(text)

        def dec(n: dict) -> Node:
            if "label" in n:
                return Leaf(n["label"], tuple(n["counts"]) if n.get("counts") else None)
            return Split(n["feature"], float(n["threshold"]), dec(n["left"]), dec(n["right"]))
        return TreeSpec(tuple(d["features"]), tuple(d["classes"]), dec(d["root"]), d.get("meta", {}))


# -- native scoring ---------------------------------------

#: Nodes up to which a tree is a nested CASE WHEN: beyond it the generated code outgrows what the JVM compiles well.
CASE_NODES = 63


def missing(features: Sequence[str]) -> Column:
    """NULL or NaN in any of ``features``: such a row has no prediction, whatever scores it."""
    cond = F.lit(False)
    for f in features:
        cond = cond | F.col(f).isNull() | F.isnan(F.col(f).cast("double"))
    return cond


def _nodes(tree: TreeSpec) -> list[tuple]:
    """(feature number, threshold, left child, leaf) by node number: the root is 0, the right child of a
    node follows its left one, and a leaf is its own left child with no threshold.  Leaves come left to right."""
    rows: list = [None]

    def fill(i: int, n: Node) -> None:
        if isinstance(n, Leaf):
            rows[i] = (0, None, i, n)
            return
        left = len(rows)
        rows.extend([None, None])
        rows[i] = (tree.features.index(n.feature), float(n.threshold), left, None)
        fill(left, n.left)
        fill(left + 1, n.right)
    fill(0, tree.root)
    return rows


def unused_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _let(value: Column, body) -> Column:
    """``body(value)``, ``value`` computed once a row."""
    return F.transform(F.array(value), body)[0]


def _case(tree: TreeSpec, value) -> Column:
    """A nested ``CASE WHEN`` that ends in ``value(node number, leaf)``."""
    rows = _nodes(tree)

    def walk(i: int) -> Column:
        feature, threshold, left, leaf = rows[i]
        if leaf is not None:
            return F.lit(value(i, leaf))
        return F.when(F.col(tree.features[feature]).cast("double") <= threshold, walk(left)).otherwise(walk(left + 1))
    return walk(0)


def leaf_node(tree: TreeSpec) -> Column:
    """Number of the leaf node a row falls into, NULL where a feature is missing."""
    rows = _nodes(tree)
    if len(rows) <= CASE_NODES:
        at = _case(tree, lambda i, leaf: i)
    else:
        feature, threshold, left = (array_literal([r[k] for r in rows], t) for k, t in enumerate(("int", "double", "int")))

        def down(x: Column) -> Column:
            def step(at: Column, _: Column) -> Column:
                right = F.get(x, F.get(feature, at)) > F.get(threshold, at)          # NULL at a leaf, its own left child
                return F.get(left, at) + F.when(right, 1).otherwise(0)
            return F.aggregate(F.sequence(F.lit(1), F.lit(tree.depth())), F.lit(0), step)
        at = _let(F.array(*[F.col(f).cast("double") for f in tree.features]), down)
    return F.when(~missing(tree.features), at)


def at_leaf(df: DataFrame, tree: TreeSpec, node: str) -> DataFrame:
    """Adds ``node``, the number of the leaf node a row falls into (NULL for a missing feature)."""
    return df.withColumn(node, leaf_node(tree))


def _at(tree: TreeSpec, node: Column, value, cast: str) -> Column:
    """``value(leaf number, leaf)`` of the leaf node ``node``; NULL for NULL."""
    seen: dict[int, object] = {}
    rows = _nodes(tree)

    def walk(i: int) -> None:
        _, _, left, leaf = rows[i]
        if leaf is None:
            walk(left)
            walk(left + 1)
        else:
            seen[i] = value(len(seen), leaf)
    walk(0)
    return F.get(array_literal([seen.get(i) for i in range(len(rows))], cast), node)


def label_at(tree: TreeSpec, node: Column) -> Column:
    return _at(tree, node, lambda i, leaf: leaf.label, "string")


def leaf_index_at(tree: TreeSpec, node: Column) -> Column:
    """Leaf number 0..L-1 (left to right)."""
    return _at(tree, node, lambda i, leaf: i, "int")


def probabilities_at(tree: TreeSpec, node: Column, prefix: str = "prob_") -> dict[str, Column]:
    """Per-class probability from the leaf's class counts (SCO-3)."""
    def share(c: int):
        return lambda i, leaf: leaf.counts[c] / sum(leaf.counts) if leaf.counts and sum(leaf.counts) else None
    return {f"{prefix}{cls}": _at(tree, node, share(c), "double") for c, cls in enumerate(tree.classes)}


def label_column(tree: TreeSpec) -> Column:
    """The predicted class label as one expression, NULL where a feature is missing."""
    if len(_nodes(tree)) <= CASE_NODES:
        return F.when(~missing(tree.features), _case(tree, lambda i, leaf: leaf.label))
    return label_at(tree, leaf_node(tree))


def predict(df: DataFrame, tree: TreeSpec, out: str = "prediction", cast: str = "string") -> DataFrame:
    """``df`` with the predicted class label in ``out``, natively (SCO-1)."""
    return df.withColumn(out, label_column(tree).cast(cast))


def with_leaf_index(df: DataFrame, tree: TreeSpec, out: str) -> DataFrame:
    node = unused_name(df, "_node")
    return at_leaf(df, tree, node).withColumn(out, leaf_index_at(tree, F.col(node))).drop(node)


# -- numpy evaluation (for Arrow UDF paths) -----------------------------------

def _flatten(tree: TreeSpec):
    feats, thr, left, right, labels = [], [], [], [], []

    def add(n: Node) -> int:
        idx = len(feats)
        feats.append(-1)
        thr.append(0.0)
        left.append(-1)
        right.append(-1)
        labels.append(None)
        if isinstance(n, Leaf):
            labels[idx] = n.label
        else:
            feats[idx] = tree.features.index(n.feature)
            thr[idx] = n.threshold
            left[idx] = add(n.left)
            right[idx] = add(n.right)
        return idx
    add(tree.root)
    return np.array(feats), np.array(thr, dtype=float), np.array(left), np.array(right), labels


def leaf_nodes_numpy(tree: TreeSpec, x: np.ndarray) -> np.ndarray:
    """Node index reached by each row of ``x`` (columns in ``tree.features`` order)."""
    feats, thr, left, right, _ = _flatten(tree)
    node = np.zeros(x.shape[0], dtype=np.int64)
    for _ in range(tree.depth()):
        f = feats[node]
        inner = f >= 0
        if not inner.any():
            break
        vals = x[np.arange(x.shape[0]), np.where(inner, f, 0)]
        go_left = vals <= thr[node]
        node = np.where(inner, np.where(go_left, left[node], right[node]), node)
    return node


def predict_numpy(tree: TreeSpec, x: np.ndarray) -> np.ndarray:
    """Labels for rows of ``x``; rows with any NaN/None feature get None."""
    _, _, _, _, labels = _flatten(tree)
    x = np.asarray(x, dtype=float)
    node = leaf_nodes_numpy(tree, np.nan_to_num(x))
    out = np.array([labels[i] for i in node], dtype=object)
    out[np.isnan(x).any(axis=1)] = None
    return out


def proba_numpy(tree: TreeSpec, x: np.ndarray) -> np.ndarray:
    """Class probabilities (n x classes); NaN for rows with missing features."""
    flat_counts: list = []

    def add(n: Node) -> None:
        flat_counts.append(n.counts if isinstance(n, Leaf) else None)
        if isinstance(n, Split):
            add(n.left)
            add(n.right)
    add(tree.root)
    x = np.asarray(x, dtype=float)
    node = leaf_nodes_numpy(tree, np.nan_to_num(x))
    k = len(tree.classes)
    table = np.full((len(flat_counts), k), np.nan)
    for i, c in enumerate(flat_counts):
        if c and sum(c) > 0:
            table[i] = np.asarray(c, dtype=float) / float(sum(c))
    out = table[node]
    out[np.isnan(x).any(axis=1)] = np.nan
    return out


# -- pyspark.ml bridge (saved model directory) -------------------------------

def _tree_stage_dir(spark: SparkSession, model_dir: str) -> str:
    """Directory of the tree inside a saved PipelineModel (or the tree itself).

    Stage metadata is read through the session's Hadoop file system, so the
    model may live on any cluster file system.
    """
    from churnlane.sources import control
    text = control.read_text(spark, f"{model_dir}/metadata")
    meta = json.loads(text.splitlines()[0]) if text else {}
    if meta.get("class", "").endswith("PipelineModel"):
        uids = meta["paramMap"]["stageUids"]
        for i, uid in enumerate(uids):
            if uid.startswith("DecisionTreeClassifier"):
                return f"{model_dir}/stages/{i}_{uid}"
        raise ValueError(f"no decision tree stage under {model_dir}")
    return model_dir


def from_saved_model(spark: SparkSession, model_dir: str, features: Sequence[str],
                     classes: Sequence[str]) -> TreeSpec:
    """Read a saved pyspark.ml decision tree into a ``TreeSpec``.

    ``features`` is the VectorAssembler input order; ``classes`` the
    StringIndexer labels (index -> label).
    """
    d = _tree_stage_dir(spark, model_dir)
    rows = spark.read.parquet(f"{d}/data").select(
        "id", "prediction", "impurityStats", "leftChild", "rightChild",
        F.col("split.featureIndex").alias("fi"),
        F.col("split.leftCategoriesOrThreshold").alias("thr"),
        F.col("split.numCategories").alias("ncat")).collect()  # bounded by model size
    by_id = {r["id"]: r for r in rows}

    def build(i: int) -> Node:
        r = by_id[i]
        if r["leftChild"] < 0:
            return Leaf(classes[int(r["prediction"])], tuple(float(x) for x in r["impurityStats"]))
        if r["ncat"] != -1:
            raise ValueError("categorical splits are not used by the churn models")
        return Split(features[r["fi"]], float(r["thr"][0]), build(r["leftChild"]), build(r["rightChild"]))
    return TreeSpec(tuple(features), tuple(classes), build(0), {"source": model_dir})


# -- fixed trees used for value-checked scoring -------------------------------

def fixed_tree(tenure_cut: float = 1800.0) -> TreeSpec:
    """The depth-3 tree of FIXTURES §2.3 (``tenure_cut=1600`` is the challenger).

    Fixed values (must equal the oracle SQL):
      total <= 300000.0:  tenure <= 1800.0 -> Yes else No
      else: monthly <= 170000.0: senior <= 0.5 -> No else Yes;  else No
    """
    return TreeSpec(
        ("senior", "tenure", "monthly", "total"), ("No", "Yes"),
        Split("total", 300000.0,
              Split("tenure", tenure_cut, Leaf("Yes"), Leaf("No")),
              Split("monthly", 170000.0,
                    Split("senior", 0.5, Leaf("No"), Leaf("Yes")),
                    Leaf("No"))),
        {"name": "fixed", "tenure_cut": tenure_cut})
