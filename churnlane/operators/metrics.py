"""Classifier metrics and frame statistics (AGG-2..5).

Every metric is one aggregation with map-side partial sums; ratios are built
from two integers at the very end so both engines round the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.operators.running import running_sums


def confusion(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Counts per (label, prediction); a NULL prediction is its own group."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, F.floor(num.cast("double") / den.cast("double") * 1000000) / 1000000)


def classification_metrics(df: DataFrame, label: str, prediction: str = "prediction",
                           positive: str = "Yes") -> DataFrame:
    """One row: n, ok, tp, predicted/actual positives, accuracy, precision, recall, f1.

    Rows with a NULL prediction count in ``n`` but are never correct.
    """
    y, p = F.col(label), F.col(prediction)
    c = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(y == p, 1).otherwise(0)).cast("bigint").alias("ok"),
        F.sum(F.when((y == positive) & (p == positive), 1).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when(p == positive, 1).otherwise(0)).cast("bigint").alias("pred_pos"),
        F.sum(F.when(y == positive, 1).otherwise(0)).cast("bigint").alias("act_pos"))
    return c.select(
        "n", "ok", "tp", "pred_pos", "act_pos",
        _ratio(F.col("ok"), F.col("n")).alias("accuracy"),
        _ratio(F.col("tp"), F.col("pred_pos")).alias("precision"),
        _ratio(F.col("tp"), F.col("act_pos")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("pred_pos") + F.col("act_pos")).alias("f1"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Distinct classes with their frequencies (AGG-5)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def _value_slot(t: T.DataType) -> str:
    """Where a column's values travel in ``column_stats``: integral -> ``i``
    (bigint), float/double -> ``d``, everything else (text, decimal, dates)
    -> ``s`` as exact text."""
    if isinstance(t, T.IntegralType):
        return "i"
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return "d"
    return "s"


def column_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact per-column statistics, one row per column (AGG-3, exact variant).

    One scan, hash aggregation only:

    1. every row becomes one ``(column, value)`` record per column (an
       ``explode`` pipelined into the next step — nothing is materialised);
    2. ``groupBy(column, value)`` with a row count: map-side partial
       aggregation de-duplicates inside every task, so a value held by a third
       of all rows is one record per task before the shuffle; only counters
       are buffered, so Spark keeps it in a hash map;
    3. ONE global aggregate over the distinct records folds in min, max,
       non-null count, row count and distinct count of every column with
       conditional aggregates — no grouping key, so even text min/max need no
       sort: each task folds its records into one buffer row.

    ``stack`` turns the single wide row into one row per column.  Numeric
    min/max land in ``min_num``/``max_num`` (double), those of integral and
    decimal columns also, exactly, in ``min_exact``/``max_exact``; text ones in
    ``min_text``/``max_text``.
    """
    cols = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    slots = [_value_slot(types[c]) for c in cols]
    typed = {"i": "bigint", "d": "double", "s": "string"}
    recs = [F.struct(F.lit(k).alias("k"),
                     *[(F.col(c).cast(typed[x]) if x == sl else F.lit(None).cast(typed[x])).alias(x)
                       for x in ("i", "d", "s")])
            for k, (c, sl) in enumerate(zip(cols, slots))]
    vals = (df.select(F.explode(F.array(*recs)).alias("_r")).select("_r.*")
              .groupBy("k", "i", "d", "s").agg(F.count(F.lit(1)).alias("n")))
    aggs = []
    for k, (c, sl) in enumerate(zip(cols, slots)):
        hit = F.col("k") == k
        v = F.col(sl) if sl != "s" or not isinstance(types[c], T.DecimalType) else F.col("s").cast(types[c])
        numeric = isinstance(types[c], T.NumericType)
        exact = numeric and sl != "d"
        none_d, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
        aggs += [F.min(F.when(hit, v)).cast("double").alias(f"mnn{k}") if numeric else none_d.alias(f"mnn{k}"),
                 F.max(F.when(hit, v)).cast("double").alias(f"mxn{k}") if numeric else none_d.alias(f"mxn{k}"),
                 F.min(F.when(hit, v)).cast("string").alias(f"mne{k}") if exact else none_s.alias(f"mne{k}"),
                 F.max(F.when(hit, v)).cast("string").alias(f"mxe{k}") if exact else none_s.alias(f"mxe{k}"),
                 none_s.alias(f"mnt{k}") if numeric else F.min(F.when(hit, v)).alias(f"mnt{k}"),
                 none_s.alias(f"mxt{k}") if numeric else F.max(F.when(hit, v)).alias(f"mxt{k}"),
                 F.coalesce(F.sum(F.when(hit & v.isNotNull(), F.col("n"))), F.lit(0)).alias(f"nn{k}"),
                 F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias(f"rows{k}"),
                 F.count(F.when(hit, v)).alias(f"nd{k}")]
    parts = ", ".join(f"'{c}', mnn{k}, mxn{k}, mne{k}, mxe{k}, mnt{k}, mxt{k}, nn{k}, rows{k} - nn{k}, nd{k}"
                      for k, c in enumerate(cols))
    return vals.agg(*aggs).selectExpr(
        f"stack({len(cols)}, {parts}) AS (col_name, min_num, max_num, min_exact, max_exact, min_text, max_text, "
        "non_null, num_nulls, distinct_count)")


def frame_info(df: DataFrame) -> DataFrame:
    """``DataFrame.info()``: column, position, type, non-null count (AGG-4) — one aggregation."""
    fields = df.schema.fields
    wide = df.agg(*[F.count(f.name).alias(f"nn{i}") for i, f in enumerate(fields)])
    parts = ", ".join(f"{i}, '{f.name}', '{f.dataType.simpleString()}', nn{i}"
                      for i, f in enumerate(fields))
    return wide.selectExpr(f"stack({len(fields)}, {parts}) AS (position, col_name, data_type, non_null)")


def rank_metrics(df: DataFrame, label: str, score: str, positive: str = "Yes", clip: float = 1e-15) -> DataFrame:
    """One row: n, n_pos, n_neg, ROC AUC and log loss of a positive-class score (AGG-2).

    Rows become one (score, positives, negatives) record per distinct score, by
    partial aggregation.  AUC is the share of (positive, negative) pairs ranked
    right, a tie counting half (mid-ranks): per score, its positives times the
    negatives below and half of those at it.  Negatives below are running sums
    over pinned ranges (``running_sums``), so the scores are never ordered in one
    task, and pairs are counted in integers.  Log loss clips scores to
    [clip, 1 - clip].  Rows without label or score (NULL, NaN) are left out; a
    metric that needs both classes is NULL where one is absent.
    """
    s = F.col(score).cast("double")
    known = df.select(F.col(label).alias("y"), s.alias("s")).filter(F.col("y").isNotNull() & F.col("s").isNotNull() & ~F.isnan("s"))
    hit = (F.col("y") == positive).cast("long")
    counted = known.groupBy("s").agg(F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg"))
    run = running_sums(counted, [], "s", ["neg"])
    whole = lambda c: c.cast("decimal(19,0)")
    p = F.greatest(F.lit(clip), F.least(F.lit(1 - clip), F.col("s")))
    sums = run.agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        F.sum(whole(F.col("pos")) * whole(2 * F.col("run_neg") - F.col("neg"))).alias("pairs"),
        F.sum(-(F.col("pos") * F.log(p) + F.col("neg") * F.log(1 - p))).alias("loss"))
    n = F.col("n_pos") + F.col("n_neg")
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    auc = F.col("pairs").cast("double") / (2 * F.col("n_pos").cast("double") * F.col("n_neg").cast("double"))
    return sums.select(F.coalesce(n, F.lit(0).cast("long")).alias("n"), F.coalesce("n_pos", F.lit(0).cast("long")).alias("n_pos"),
                       F.coalesce("n_neg", F.lit(0).cast("long")).alias("n_neg"),
                       F.when(both, F.floor(auc * 1000000) / 1000000).alias("auc"),
                       F.when(n > 0, F.round(F.col("loss") / n, 6)).alias("log_loss"))
