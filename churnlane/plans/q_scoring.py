"""Queries: scoring paths on the fixed tree (SCO-1..4, WIN-2, PRJ-7, SNK-8)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.functions.columns import feature_columns
from churnlane.operators.contract import Contract, ModelStore, capture_schema
from churnlane.operators.ordering import row_position
from churnlane.operators.score import multi_udf, score_columns, score_map, score_multi, score_stored, score_struct
from churnlane.operators.train import fit_tree, leaf_class_counts, transform_labels
from churnlane.operators.tree import fixed_tree, from_saved_model, missing, predict, predict_numpy
from churnlane.plans import common
from churnlane.plans.oracle_sql import BASE, BPZ, BPZS, P, leaf_case, tree_case, with_ctes
from churnlane.plans.registry import query
from churnlane.session import pin, scratch_path
from churnlane.sources.tables import FEATURES, KEY, LABEL

_TEST_SCORED = f"""{BPZS}
SELECT customer_id, senior, tenure, monthly, total, {tree_case()} AS prediction FROM test"""


def _test_features(spark, sf):
    _, test = common.train_test(spark, sf)
    return test.select(KEY, *FEATURES)


@query("score_columns", _TEST_SCORED, "SCO-1 PRJ-5")
def q_score_columns(spark, sf):
    """``withColumn("prediction", f(*cols))``: tree bound to columns by position, native CASE."""
    x = _test_features(spark, sf)
    return score_columns(x, fixed_tree(), feature_columns(x, KEY))


@query("score_struct", _TEST_SCORED, "SCO-2 PRJ-6")
def q_score_struct(spark, sf):
    """Opaque-model path: Arrow UDF over ``struct(features)`` returning a string."""
    return score_struct(_test_features(spark, sf), fixed_tree())


@query("score_map", _TEST_SCORED, "SCO-4")
def q_score_map(spark, sf):
    """User model class applied per Arrow batch with ``mapInPandas``."""
    return score_map(_test_features(spark, sf), fixed_tree())


@query("score_multi", f"""{BPZS},
lc AS (SELECT leaf, sum(CASE WHEN churn = 'No' THEN 1 ELSE 0 END) AS n_no,
              sum(CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END) AS n_yes
       FROM (SELECT {leaf_case()} AS leaf, churn FROM train) GROUP BY leaf),
t AS (SELECT *, {leaf_case()} AS leaf FROM test)
SELECT customer_id, senior, tenure, monthly, total,
       CAST(n_no AS double) / CAST(n_no + n_yes AS double) AS prob_No,
       CAST(n_yes AS double) / CAST(n_no + n_yes AS double) AS prob_Yes,
       {tree_case()} AS prediction
FROM t LEFT JOIN lc USING (leaf)""", "SCO-3 FN-5")
def q_score_multi(spark, sf):
    """Probabilities per class + label; leaf class shares estimated on the train side."""
    train, test = common.train_test(spark, sf, pinned=True)
    tree = leaf_class_counts(fixed_tree(), train, LABEL)
    return score_multi(test.select(KEY, *FEATURES), tree)


@query("row_position", f"""{BPZS}
SELECT customer_id, row_number() OVER (ORDER BY customer_id) - 1 AS prediction FROM test""", "WIN-2")
def q_row_position(spark, sf):
    """The custom-code model: 0..n-1 over the scored rows, numbered by key order."""
    return row_position(_test_features(spark, sf).select(KEY), KEY, "prediction")


@query("surrogate_id", f"""{BPZ}
SELECT row_number() OVER (ORDER BY customer_id) - 1 AS unique_id, senior, tenure, monthly, total, churn
FROM z""", "PRJ-7")
def q_surrogate_id(spark, sf):
    """Stable surrogate key after ``na.drop`` (not partition-dependent like monotonically_increasing_id)."""
    z = common.z(spark, sf)
    return row_position(z, KEY, "unique_id").drop(KEY)


@query("preview", f"{_TEST_SCORED} ORDER BY customer_id LIMIT 10", "SNK-8")
def q_preview(spark, sf):
    x = _test_features(spark, sf)
    return score_columns(x, fixed_tree()).orderBy(F.col(KEY)).limit(10)


@query("surrogate_id_fast", f"""{BPZ}
SELECT senior, tenure, monthly, total, churn, CAST(1 AS BIGINT) AS rows_of_id FROM z""", "PRJ-7 G10")
def q_surrogate_id_fast(spark, sf):
    """``monotonically_increasing_id`` after ``na.drop`` (partition-dependent values, pinned by checkpoint):
    every row once, under an id that no other has."""
    from churnlane.operators.ordering import surrogate_key
    rows = surrogate_key(common.z(spark, sf).drop(KEY), "unique_id")
    return rows.groupBy("unique_id").agg(*[F.first(c).alias(c) for c in (*FEATURES, LABEL)],
                                         F.count("*").alias("rows_of_id")).drop("unique_id")


class Advice:
    """A user's model: the fixed tree's label turned into advice and a flag (numpy inside, batch by batch)."""

    def load(self):
        self.tree = fixed_tree()

    def predict(self, pdf):
        labels = pd.Series(predict_numpy(self.tree, pdf.to_numpy(dtype=float, na_value=np.nan)), index=pdf.index)
        return pd.DataFrame({"advice": labels.map({"Yes": "call", "No": "wait"}).fillna("ask"),
                             "at_risk": labels.eq("Yes").astype("int64")})


@query("score_user_model", f"""{with_ctes(BASE, P)}, s AS (SELECT *, {tree_case()} AS label FROM p)
SELECT customer_id, senior, tenure, monthly, total,
       CASE label WHEN 'Yes' THEN 'call' WHEN 'No' THEN 'wait' ELSE 'ask' END AS advice,
       CAST(CASE WHEN label = 'Yes' THEN 1 ELSE 0 END AS BIGINT) AS at_risk
FROM s""", "SCO-4 SNK-9 CTR-1")
def q_score_user_model(spark, sf):
    """A user class with post-processing and two outputs, stored and scored by URI."""
    rows = common.p(spark, sf).select(KEY, *FEATURES)
    store = ModelStore(spark, scratch_path(spark, "models"))
    outputs = T.StructType().add("advice", "string").add("at_risk", "long")
    store.log_model("advice", Contract(capture_schema(rows, FEATURES), outputs=outputs), aliases=["live"],
                    user_model=Advice())
    return score_stored(spark, store, "advice@live", rows)


_HOLES = ", ".join(f"CASE WHEN customer_id % 7 = {i} THEN NULL ELSE {f} END AS {f}" for i, f in enumerate(FEATURES))


@query("missing_rule", f"""{with_ctes(BASE, P)}, h AS (SELECT customer_id, {_HOLES} FROM p), s AS (SELECT customer_id, {tree_case()} AS label FROM h)
SELECT customer_id, label AS native, label AS by_struct, label AS by_map, label AS by_multi, true AS fitted_agrees FROM s""",
       "SCO-1 SCO-2 SCO-3 SCO-4 FIT-1")
def q_missing_rule(spark, sf):
    """One rule for NULL and NaN features: no prediction, natively, by struct UDF, by batch and by a fitted pipeline."""
    p = pin(common.p(spark, sf))
    hole = lambda i, f: F.when(F.col(KEY) % 7 == i, F.when(F.col(KEY) % 2 == 0, F.lit(float("nan")))).otherwise(
        F.when(F.col(f).isNull() & (F.col(KEY) % 2 == 1), F.lit(float("nan"))).otherwise(F.col(f)))
    h = p.select(KEY, *[hole(i, f).alias(f) for i, f in enumerate(FEATURES)])
    model, classes = fit_tree(p.na.drop(), FEATURES, LABEL, max_depth=3, pin_input=False)
    path = scratch_path(spark, "fitted")
    model.write().overwrite().save(path)
    fitted = from_saved_model(spark, path, FEATURES, classes)
    rows = predict(transform_labels(model, h, FEATURES, classes, "ml"), fitted, "fitted").withColumn(
        "fitted_agrees", F.col("ml").eqNullSafe(F.col("fitted")) & (F.col("ml").isNull() == missing(FEATURES)))
    tree = fixed_tree()
    rows = score_struct(score_columns(rows, tree, out="native"), tree, "by_struct")
    rows = rows.withColumn("by_multi", multi_udf(tree)(F.struct(*FEATURES))["prediction"])
    return score_map(rows, tree, out="by_map").select(KEY, "native", "by_struct", "by_map", "by_multi", "fitted_agrees")
