"""Column statistics that an append updates without a scan (AGG-3).

Exact distinct counts and quantiles need all rows again after every append.  A
batch's sketches need only its own: one aggregation of the batch gives, for each
column, rows, nulls, minimum and maximum (exact) and two of Spark's mergeable
sketches, HLL for distinct values and KLL for quantiles.  They are stored as
one row a column and batch; the table's statistics are the merge of these rows,
whose number does not depend on the rows of the table.

Bounds: with ``lg_k`` 12 the distinct count's standard error is
``1.04 / sqrt(2 ** lg_k)``, 1.6 % (a single pass does a little better, since it may also
use the order of its input); KLL with ``k`` 200 ranks a quantile within 1.65 % (99 %
confidence).  Merging in any order and grouping gives the same HLL estimate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.sources import control

LG_K, KLL_K = 12, 200
QUANTILES = (0.25, 0.5, 0.75)


def _hllable(c: Column, t: T.DataType) -> Column:
    """HLL takes integers, text and bytes; equal values of other types have equal texts."""
    if isinstance(t, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)):
        return c
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return (c + F.lit(0.0)).cast("string")               # -0.0 is 0.0
    return c.cast("long") if isinstance(t, T.IntegralType) else c.cast("string")


def sketch_columns(df: DataFrame, columns: Sequence[str] | None = None, lg_k: int = LG_K, kll_k: int = KLL_K) -> DataFrame:
    """One row per column: n, nulls, min/max (as text, and as numbers), hll, kll (NULL for columns that are no numbers): one aggregation."""
    cols = list(columns or df.columns)
    aggs, parts = [], []
    for i, c in enumerate(cols):
        t = df.schema[c].dataType
        v, numeric = F.col(c), isinstance(t, T.NumericType)
        none = F.lit(None)
        number = v.cast("double") if numeric else none.cast("double")
        aggs += [F.count(F.lit(1)).alias(f"n{i}"), (F.count(F.lit(1)) - F.count(v)).alias(f"z{i}"),
                 F.min(v).cast("string").alias(f"lo{i}"), F.max(v).cast("string").alias(f"hi{i}"),
                 (F.min(number) if numeric else none.cast("double")).alias(f"ln{i}"), (F.max(number) if numeric else none.cast("double")).alias(f"hn{i}"),
                 F.hll_sketch_agg(_hllable(v, t), lg_k).alias(f"h{i}"),
                 (F.kll_sketch_agg_double(number, F.lit(kll_k)) if numeric else none.cast("binary")).alias(f"k{i}")]
        parts.append(F.struct(F.lit(c).alias("col_name"), F.lit(t.simpleString()).alias("data_type"),
                              *[F.col(f"{a}{i}").alias(b) for a, b in (("n", "n"), ("z", "nulls"), ("lo", "min_text"), ("hi", "max_text"),
                                                                      ("ln", "min_num"), ("hn", "max_num"), ("h", "hll"), ("k", "kll"))]))
    return df.agg(*aggs).select(F.explode(F.array(*parts)).alias("s")).select("s.*")


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row per column from the rows of any number of batches; of the same form, so merges can be merged.

    Text is compared as text: minimum and maximum of numbers are those of the number columns.
    """
    return sketches.groupBy("col_name", "data_type").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
        F.min("min_num").alias("min_num"), F.max("max_num").alias("max_num"), F.hll_union_agg("hll").alias("hll"),
        F.kll_merge_agg_double("kll").alias("kll"))


def read_sketches(merged: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Statistics from merged sketches: exact counts and bounds, estimated distinct count and quantiles (an array in their order)."""
    number = F.col("min_num").isNotNull()
    return merged.select(
        "col_name", "data_type", "n", "nulls", F.when(~number, F.col("min_text")).alias("min_text"), F.when(~number, F.col("max_text")).alias("max_text"),
        "min_num", "max_num", F.hll_sketch_estimate("hll").alias("distinct_estimate"),
        F.when(number, F.array(*[F.kll_sketch_get_quantile_double("kll", F.lit(q)) for q in quantiles])).alias("quantiles"))


class SketchLog:
    """Sketches of a table, one folder a batch below ``root``; a batch written again replaces its own."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def add(self, batch: DataFrame, batch_id: int, columns: Sequence[str] | None = None) -> None:
        sketch_columns(batch, columns).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/batch={batch_id}")

    def merged(self) -> DataFrame:
        batches = control.list_numbered(self.spark, self.root, r"batch=(\d+)", "_SUCCESS") or []
        if not batches:
            raise ValueError(f"no sketches below {self.root}")
        return merge_sketches(self.spark.read.parquet(*[f"{self.root}/batch={b}" for b in batches]))

    def stats(self, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
        return read_sketches(self.merged(), quantiles)
