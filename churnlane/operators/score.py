"""Scoring paths (SCO-1..4, JN-2, JN-3).

Native first: a tree model becomes a few projections (``predict``) inside
whole-stage codegen with no Python worker.
For opaque models the same contract runs through Arrow batches: a
``pandas_udf`` over a struct (SCO-2), a struct-returning ``pandas_udf`` for
several outputs (SCO-3), or ``mapInPandas`` for a user class that sees whole
batches (SCO-4).  All four agree on the same tree, NULL and NaN features
included (both are missing); a query and tests check it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.operators.contract import Contract, ModelStore
from churnlane.operators.features import coerce_key, join_hot_split, key_list, lookup
from churnlane.operators.tree import (TreeSpec, at_leaf, label_at, predict, predict_numpy, probabilities_at,
                                      proba_numpy, unused_name)
from churnlane.session import ship


def _positional(tree: TreeSpec, cols: Sequence[str]) -> TreeSpec:
    """Bind the tree's features to ``cols`` by position (a UDF called as ``f(*cols)``)."""
    if list(cols) == list(tree.features):
        return tree
    mapping = dict(zip(tree.features, cols))
    from churnlane.operators.tree import Leaf, Split

    def walk(n):
        if isinstance(n, Leaf):
            return n
        return Split(mapping[n.feature], n.threshold, walk(n.left), walk(n.right))
    return TreeSpec(tuple(cols), tree.classes, walk(tree.root), dict(tree.meta))


def score_columns(df: DataFrame, tree: TreeSpec, cols: Sequence[str] | None = None,
                  out: str = "prediction") -> DataFrame:
    """Append a prediction computed from positional columns, natively (SCO-1)."""
    t = _positional(tree, cols) if cols else tree
    return predict(df, t, out)


def struct_udf(tree: TreeSpec) -> Callable[[Column], Column]:
    """Arrow UDF ``f(struct(features)) -> string`` for an opaque model (SCO-2)."""
    ship()
    feats = list(tree.features)

    @F.pandas_udf(T.StringType())
    def predict(s: pd.DataFrame) -> pd.Series:
        x = s[feats].to_numpy(dtype=float, na_value=np.nan)
        return pd.Series(predict_numpy(tree, x), dtype=object)
    return predict


def score_struct(df: DataFrame, tree: TreeSpec, out: str = "prediction") -> DataFrame:
    f = struct_udf(tree)
    return df.withColumn(out, f(F.struct(*[F.col(c) for c in tree.features])))


def score_multi(df: DataFrame, tree: TreeSpec, prefix: str = "prob_") -> DataFrame:
    """Several outputs: one probability per class plus the label (SCO-3), native."""
    node = unused_name(df, "_node")
    at = F.col(node)
    outputs = probabilities_at(tree, at, prefix) | {"prediction": label_at(tree, at)}
    return at_leaf(df, tree, node).withColumns(outputs).drop(node)


def multi_udf(tree: TreeSpec, prefix: str = "prob_") -> Callable[[Column], Column]:
    """The same three outputs from an Arrow UDF returning a struct (opaque models)."""
    ship()
    feats = list(tree.features)
    fields = [T.StructField(f"{prefix}{c}", T.DoubleType()) for c in tree.classes]
    fields.append(T.StructField("prediction", T.StringType()))

    @F.pandas_udf(T.StructType(fields))
    def predict(s: pd.DataFrame) -> pd.DataFrame:
        x = s[feats].to_numpy(dtype=float, na_value=np.nan)
        p = proba_numpy(tree, x)
        res = pd.DataFrame({f"{prefix}{c}": p[:, i] for i, c in enumerate(tree.classes)})
        res["prediction"] = pd.Series(predict_numpy(tree, x), dtype=object)
        return res
    return predict


def _schema_of(outputs: T.StructType | str, out: str) -> T.StructType:
    """Output columns of a model: a struct as it is, or one column ``out`` of a type."""
    return outputs if isinstance(outputs, T.StructType) else T.StructType.fromDDL(f"`{out}` {outputs}")


def score_map(df: DataFrame, model, features: Sequence[str] | None = None,
              outputs: T.StructType | str = "string", out: str = "prediction") -> DataFrame:
    """A user model that sees whole Arrow batches (SCO-4) via ``mapInPandas``.

    ``model`` is a ``TreeSpec`` or any object with ``predict(pdf)`` that takes
    a frame of ``features`` and returns one value a row (a Series, array or
    list) or a frame with the columns of ``outputs``; post-processing is the
    object's own affair.  An optional ``load()`` runs once per task.  The
    result is the input with the outputs; columns of their names are replaced.
    """
    ship()
    feats = list(features or model.features)
    added = _schema_of(outputs, out)
    names = {f.name.lower() for f in added.fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    schema = T.StructType(kept + added.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if hasattr(model, "load"):
            model.load()
        for b in batches:
            if isinstance(model, TreeSpec):
                got = predict_numpy(model, b[feats].to_numpy(dtype=float, na_value=np.nan))
            else:
                got = model.predict(b[feats])
            res = b[[f.name for f in kept]].copy()
            for f in added.fields:
                values = got[f.name] if isinstance(got, pd.DataFrame) else got
                res[f.name] = pd.Series(np.asarray(values), index=b.index,
                                        dtype=object if isinstance(f.dataType, T.StringType) else None)
            yield res
    return df.mapInPandas(run, schema)


def score_stored(spark: SparkSession, store: ModelStore, uri: str, df: DataFrame,
                 result_type: str | None = None, out: str = "prediction") -> DataFrame:
    """Score ``df`` with the stored model ``uri`` (``name@alias`` or ``name/version``), appending its outputs.

    The path follows from what was stored, not from its size: a tree compiles
    natively, a user object runs over Arrow batches, a fitted pipeline
    transforms.  ``result_type`` casts a single output.
    """
    contract = store.load_contract(uri)
    if contract.tree is not None:
        return predict(df, contract.tree, out, result_type or contract.result_type)
    if contract.outputs is not None:
        scored = score_map(df, store.load_user_model(uri), contract.features, contract.outputs)
        names = contract.outputs.fieldNames()
        return scored.withColumn(names[0], F.col(names[0]).cast(result_type)) if result_type and len(names) == 1 else scored
    from churnlane.operators.train import transform_labels
    rows = transform_labels(store.load_pipeline(uri), df, contract.features, contract.classes, out)
    return rows.withColumn(out, F.col(out).cast(result_type or contract.result_type))


def score_batch(spark: SparkSession, contract: Contract, keys: DataFrame,
                result_type: str | None = None, out: str = "prediction",
                skew_fraction: float | None = None, store: ModelStore | None = None,
                uri: str | None = None) -> DataFrame:
    """Keys -> features from the model's own lookups -> prediction (JN-2, CTR-3).

    Left join: a key with no features keeps a NULL prediction.  Pass
    ``skew_fraction`` when the key side may repeat one key very often, and
    ``store`` with ``uri`` for a model that is no tree (``score_stored``).
    """
    feats = lookup(spark, keys, contract.lookups, "left", skew_fraction)
    if contract.tree is None:
        if store is None or uri is None:
            raise ValueError("a contract without a tree needs the store and the model's URI")
        return score_stored(spark, store, uri, feats, result_type, out)
    return predict(feats, contract.tree, out, result_type or contract.result_type)


def score_requests(spark: SparkSession, contract: Contract, requests: DataFrame,
                   snapshot: DataFrame, key: str | Sequence[str], out: str = "prediction",
                   skew_fraction: float | None = None) -> DataFrame:
    """Online lookup of request keys against a newest-per-key snapshot (JN-3).

    Request keys are text; they are coerced to the snapshot key type with
    ``try_cast`` (``"x"`` becomes NULL and matches nothing).  Left join from
    the request side, so every request gets an answer row.  ``skew_fraction``
    splits keys requested more often than that share off to a bounded
    broadcast (``join_hot_split``).
    """
    keys = key_list(key)
    req = coerce_key(requests, keys, snapshot)
    snap = snapshot.select(*keys, *contract.features)
    if skew_fraction:
        feats = join_hot_split(req, snap, keys, skew_fraction, "left")
    else:
        feats = req.join(snap, keys, "left")
    return predict(feats, contract.tree, out)
