"""Fitting (FIT-1..3) and the relational core of a split search (FIT-2).

``fit_tree`` trains a ``pyspark.ml`` pipeline (StringIndexer ->
VectorAssembler -> DecisionTreeClassifier) on the DataFrame itself — the
reference collects to pandas first; here the fit is distributed.  Class
labels are indexed alphabetically (``No`` = 0, ``Yes`` = 1), matching the
reference's sorted class list (G16).  Spark bins continuous features
(``maxBins``), so thresholds differ from an exact-split learner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.operators.contract import Contract, capture_schema
from churnlane.operators.tree import TreeSpec, from_saved_model, missing, with_leaf_index
from churnlane.session import default_buckets, pin, scratch_path, shared_dir

SPARK_MAX_DEPTH = 30  # "unlimited" depth maps to Spark's cap


def tree_pipeline(features: Sequence[str], label: str, max_depth: int | None = 3, seed: int = 42,
                  max_bins: int = 32):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    if max_depth is not None and max_depth > SPARK_MAX_DEPTH:
        raise ValueError(f"max_depth above {SPARK_MAX_DEPTH}, the engine's limit; None asks for that limit")
    depth = SPARK_MAX_DEPTH if max_depth is None else max_depth
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc",
                      handleInvalid="error"),
        VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep"),
        # node ids cached per row (checkpointed every 10 iterations into the
        # shared checkpoint dir) and a larger per-pass node budget: deep trees
        # take fewer passes over the data and no growing lineage; the learned
        # tree is the same
        DecisionTreeClassifier(featuresCol="_features", labelCol="_label", maxDepth=depth,
                               seed=seed, maxBins=max_bins, cacheNodeIds=True,
                               checkpointInterval=10, maxMemoryInMB=512),
    ])


def fit_tree(df: DataFrame, features: Sequence[str], label: str, max_depth: int | None = 3,
             seed: int = 42, pin_input: bool = True, max_bins: int = 32):
    """Fit and return ``(PipelineModel, classes)``.

    The fit reads its input several times (label indexing, split candidates,
    binning); with ``pin_input`` the selected columns are checkpointed once so
    the upstream plan is not recomputed for each pass.
    """
    shared_dir(df.sparkSession)          # checkpoint dir for the node-id cache
    data = df.select(*features, label)
    if pin_input:
        data = pin(data)
    model = tree_pipeline(features, label, max_depth, seed, max_bins).fit(data)
    classes = tuple(model.stages[0].labels)
    return model, classes


def fit_and_log(store, name: str, training: DataFrame, features: Sequence[str], label: str,
                max_depth: int | None = 3, seed: int = 42, lookups: Sequence = (), key: str | None = None,
                aliases: Sequence[str] = ()):
    """Fit, store and name a model in one step, with or without feature lookups (FIT-3).

    The stored contract has the input and output signatures, the lookups and
    the compiled tree.  Returns ``(model, contract, version)``.
    """
    model, classes = fit_tree(training, features, label, max_depth, seed)
    spark = training.sparkSession
    path = scratch_path(spark, "fitted")
    model.write().overwrite().save(path)
    contract = Contract(capture_schema(training, features), label, classes, "string", tuple(lookups), key,
                        from_saved_model(spark, path, features, classes), T.StructType().add("prediction", "string"))
    return model, contract, store.log_model(name, contract, model, aliases)


def transform_labels(model, df: DataFrame, features: Sequence[str], classes: Sequence[str],
                     out: str = "prediction") -> DataFrame:
    """``df`` with the fitted pipeline's label in ``out``; rows with a missing feature get NULL.

    The assembler keeps such rows (its NaN would take a branch), so the label
    is masked by the rule that native scoring has.
    """
    label_of = F.element_at(F.array(*[F.lit(c) for c in classes]), F.col("prediction").cast("int") + 1)
    label = F.when(~missing(features), label_of)
    rows = df.drop("prediction", "probability", "rawPrediction")
    return model.transform(rows).select(*rows.columns, label.alias(out))


def leaf_class_counts(tree: TreeSpec, df: DataFrame, label: str) -> TreeSpec:
    """Re-estimate leaf class counts of a fixed-structure tree from ``df``.

    One aggregation; only ``leaves x classes`` rows reach the driver.
    """
    rows = (with_leaf_index(df.withColumn("_y", F.col(label)), tree, "_leaf")
              .where(F.col("_leaf").isNotNull() & F.col(label).isin(*tree.classes))
              .groupBy("_leaf", "_y").agg(F.count(F.lit(1)).alias("_n")).collect())
    counts: dict[int, list[float]] = {}
    for r in rows:
        c = counts.setdefault(r["_leaf"], [0.0] * len(tree.classes))
        if r["_y"] in tree.classes:
            c[tree.classes.index(r["_y"])] += r["_n"]
    return tree.with_counts(counts)


def best_split(df: DataFrame, features: Sequence[str], label: str, positive: str = "Yes",
               buckets: int | None = None) -> DataFrame:
    """Best single (feature, threshold) by weighted Gini, exact (FIT-2).

    Candidate thresholds are the distinct feature values; left side is
    ``x <= threshold``.  Steps, all distributed:
      unpivot -> per (feature, value) class counts (partial aggregation) ->
      running counts along each feature's value order -> Gini -> global top-1.

    The per-value rows are range-partitioned on (feature, value) and pinned, so
    a feature spreads over adjacent ranges: running counts are taken within
    (range, feature), and the totals of the ranges before (at most ranges +
    features rows) are added.  No task holds a whole feature's distinct values.
    """
    ranges = buckets or default_buckets(df.sparkSession)
    long = df.select(F.col(label).alias("_y"), *[F.col(f).cast("double").alias(f) for f in features]) \
             .unpivot("_y", list(features), "f", "x")
    g = (long.groupBy("f", "x")
             .agg(F.sum(F.when(F.col("_y") == positive, 1).otherwise(0)).cast("bigint").alias("y"),
                  F.count(F.lit(1)).alias("n")))
    # sampled cut points differ between runs, so the ranges are fixed by the checkpoint; both uses read that
    gb = pin(g.repartitionByRange(ranges, "f", "x").withColumn("b", F.spark_partition_id()))
    tot_b = gb.groupBy("f", "b").agg(F.sum("y").alias("by"), F.sum("n").alias("bn"))
    w_prev = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    w_f = Window.partitionBy("f")
    offs = tot_b.select("f", "b",
                        F.coalesce(F.sum("by").over(w_prev), F.lit(0)).alias("oy"),
                        F.coalesce(F.sum("bn").over(w_prev), F.lit(0)).alias("on"),
                        F.sum("by").over(w_f).alias("ty"), F.sum("bn").over(w_f).alias("tn"))
    w_in = Window.partitionBy("f", "b").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    c = (gb.withColumn("ly0", F.sum("y").over(w_in)).withColumn("ln0", F.sum("n").over(w_in))
           .join(F.broadcast(offs), ["f", "b"])
           .select("f", "x", (F.col("ly0") + F.col("oy")).alias("ly"),
                   (F.col("ln0") + F.col("on")).alias("ln"), "ty", "tn"))
    ly, ln, ty, tn = (F.col(x) for x in ("ly", "ln", "ty", "tn"))
    d = lambda e: e.cast("double")
    gini = F.lit(2.0) * (d(ly * (ln - ly)) / d(ln) + d((ty - ly) * ((tn - ln) - (ty - ly))) / d(tn - ln)) / d(tn)
    s = c.where(ln < tn).select("f", "x", gini.alias("exact"))      # rounded in the output only
    return s.orderBy("exact", "f", "x").limit(1).select("f", "x", (F.floor(F.col("exact") * 1000000) / 1000000).alias("gini"))
