"""Column-level building blocks: casts, completeness, packing, names, hashing.

All of these return plain Catalyst expressions or single projections, so
they stay inside whole-stage codegen and collapse with neighbouring
projections.
"""

from __future__ import annotations

import json

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def try_cast_columns(df: DataFrame, columns: Iterable[str], to: str = "double") -> DataFrame:
    """Cast several columns in place in ONE projection (PRJ-2, FN-1).

    ANSI mode is on in Spark 4, so ``cast(' ' as double)`` raises; the
    reference means "unparseable becomes NULL", which is ``try_cast``.
    """
    cols = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast(to) for c in cols})


def cast_by_type(df: DataFrame, from_types: Sequence[type] | type, to: str = "double") -> DataFrame:
    """Cast every column whose type is one of ``from_types`` (PRJ-3)."""
    if not isinstance(from_types, (list, tuple)):
        from_types = (from_types,)
    targets = [f.name for f in df.schema.fields if isinstance(f.dataType, tuple(from_types))]
    return try_cast_columns(df, targets, to)


def complete_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep rows without NULL/NaN (FLT-1 whole row, FLT-2 over ``subset``)."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; absent names are ignored, names match case-insensitively (PRJ-4)."""
    return df.drop(*names)


def feature_columns(df: DataFrame, *exclude: str) -> list[str]:
    """Feature list taken from the frame itself (PRJ-5)."""
    low = {e.lower() for e in exclude}
    return [c for c in df.columns if c.lower() not in low]


def pack(features: Sequence[str], name: str = "features") -> Column:
    """``struct(features)`` as model input (PRJ-6, FN-2)."""
    return F.struct(*[F.col(c) for c in features]).alias(name)


def last_name_part(c: Column | str) -> Column:
    """Last part of a dotted name: ``cat.schema.model`` -> ``model`` (FN-3)."""
    return F.element_at(F.split(c if isinstance(c, Column) else F.col(c), r"\."), -1)


def route_name(name: Column | str, version: Column | str) -> Column:
    """``f"{name}-{version}"`` (FN-4)."""
    as_col = lambda x: x if isinstance(x, Column) else F.col(x)
    return F.concat_ws("-", as_col(name), as_col(version).cast("string"))


def hash_bucket(key: Column | str, salt: str = "", buckets: int = 100) -> Column:
    """Deterministic 0..buckets-1 bucket of a key.

    First 8 hex digits of ``md5(salt || cast(key as string))`` read as an
    unsigned 32-bit number, modulo ``buckets``.  Independent of partitioning,
    so a split or a traffic route does not change when the data is
    re-partitioned (unlike ``randomSplit``), and reproducible in any SQL
    engine that has ``md5``.
    """
    k = (key if isinstance(key, Column) else F.col(key)).cast("string")
    if salt:
        k = F.concat(F.lit(salt), k)
    h = F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(buckets)).cast("bigint")


def array_literal(values: Sequence, element_type: str) -> Column:
    """A constant array as one JSON text parsed by ``from_json``: a single
    string crosses to the JVM and the optimizer folds the parse into one
    literal.  (``lit(list)`` converts element by element — ~6 s for 7,000
    values — and an array of ``lit`` expressions is analysed node by node.)"""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{element_type}>")
