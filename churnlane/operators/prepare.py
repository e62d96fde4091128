"""Prepare raw churn rows: cast features to double, keep complete rows (PRJ-2, FLT-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from churnlane.functions.columns import complete_rows, try_cast_columns
from churnlane.sources.tables import FEATURES


def cast_features(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Features to double in one projection; unparseable text becomes NULL."""
    return try_cast_columns(df, columns, "double")


def prepare(df: DataFrame, columns: Sequence[str] = FEATURES,
            subset: Sequence[str] | None = None) -> DataFrame:
    """Cast, then drop incomplete rows.

    ``subset=None`` checks every column (the batch notebooks); pass the
    selected columns to reproduce the pipeline's narrower check (G3).
    """
    return complete_rows(cast_features(df, columns), subset)
