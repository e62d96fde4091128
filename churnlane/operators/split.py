"""Train/test splits and examples (SPL-1, SPL-2, SPL-4).

The default split is a hash of the key, not ``randomSplit``: membership of a
``randomSplit`` row depends on how the input is partitioned (it samples per
partition after a local sort), so the same data read with a different file
layout or executor count lands differently.  A key hash is a pure per-row
predicate: no shuffle, pushed into the scan's projection, identical at any
scale, and expressible in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.functions.columns import hash_bucket
from churnlane.session import pin
from churnlane.sources.tables import KEY


def hash_split(df: DataFrame, key: str = KEY, train_pct: int = 80,
               salt: str = "") -> tuple[DataFrame, DataFrame]:
    b = hash_bucket(key, salt)
    return df.where(b < train_pct), df.where((b >= train_pct) | b.isNull())   # NULL keys: test, as in split_xy


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2),
                 seed: int = 42, pin_input: bool = True) -> list[DataFrame]:
    """The reference's ``randomSplit([.8, .2], seed=42)``, kept as an option.

    Each split re-evaluates the input and samples it per partition; the parts
    are disjoint and complete only if every evaluation yields the same rows
    in the same partitions.  The input is therefore pinned (reliable
    checkpoint) first: computed once, and identical for every split even
    after an executor loss.
    """
    src = pin(df) if pin_input else df
    return src.randomSplit(list(weights), seed=seed)


def split_xy(df: DataFrame, key: str, features: Sequence[str], label: str,
             train_pct: int = 80) -> dict[str, DataFrame]:
    """Split features and labels *together*.

    One tagged frame (``xy``: key, features, label, ``part``) is the single
    pass; the four familiar frames are projections + filters of it, so X and
    Y rows of a part are aligned by construction — no join back on the key.
    """
    xy = df.select(key, *features, label).withColumn(
        "part", F.when(hash_bucket(key) < train_pct, "train").otherwise("test"))
    tr, te = xy.where(F.col("part") == "train"), xy.where(F.col("part") == "test")
    return {
        "xy": xy,
        "x_train": tr.select(key, *features), "y_train": tr.select(key, label),
        "x_test": te.select(key, *features), "y_test": te.select(key, label),
    }


def input_example(df: DataFrame, key: str = KEY, n: int = 3) -> DataFrame:
    """First ``n`` rows by key as a model input example (a top-k: the limit IS the feature)."""
    return df.orderBy(F.col(key).asc()).limit(n)
