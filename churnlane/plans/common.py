"""Frames shared by the registered queries (Spark side of the oracle CTEs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlane.operators.prepare import cast_features, prepare
from churnlane.operators.split import hash_split
from churnlane.session import ensure_conf, pin
from churnlane.sources.tables import base


def b(spark: SparkSession, sf: str) -> DataFrame:
    ensure_conf(spark)
    return base(spark, sf)


def p(spark: SparkSession, sf: str) -> DataFrame:
    """``base`` with features cast to double (unparseable -> NULL)."""
    return cast_features(b(spark, sf))


def z(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared rows: cast + complete rows only."""
    return prepare(b(spark, sf))


def train_test(spark: SparkSession, sf: str, pinned: bool = False) -> tuple[DataFrame, DataFrame]:
    """80/20 key-hash split of ``z``; ``pinned`` materialises ``z`` once when
    both sides feed separate jobs (fit on one, score the other)."""
    zz = pin(z(spark, sf)) if pinned else z(spark, sf)
    return hash_split(zz)
