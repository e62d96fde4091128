"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnlane.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Everything ASCII that is neither a digit nor a lower-case letter separates words.
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


_recorded: ContextVar[tuple[list[str], ...]] = ContextVar("recorded", default=())


@contextmanager
def recorded():
    """The folders that ``stage`` writes meanwhile in this thread, for a later ``discard``.

    An operator discards its intermediate tables as soon as what it returns does
    not read them; the caller that has written out an operator's result
    discards the rest.
    """
    paths: list[str] = []
    before = _recorded.set((*_recorded.get(), paths))
    try:
        yield paths
    finally:
        _recorded.reset(before)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Remove staged folders that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the cluster's shared scratch root and read it back.

    Cuts the lineage: a lost executor re-reads files.  Row ids assigned in
    ``df`` are fixed from here on, whatever order a re-read would have.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    for paths in _recorded.get():
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Rows of numbers (at most some 64 MB) that one broadcast may have; beyond it, joins shuffle.
MAX_BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if its counted ``rows`` are within the bound, else ``df`` for a shuffle join."""
    return F.broadcast(df) if rows <= max_rows else df


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(c, UPPER, UPPER.lower())


def word_text(c: Column) -> Column:
    """The words of ``c`` (lower-cased A-Z), joined by one space; null counts as empty."""
    return F.trim(F.regexp_replace(lower_ascii(F.coalesce(c, F.lit(""))), NOT_WORD, " "))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row, also where a lambda reads it."""
    return F.transform(F.array(value), body)[0]


def steps(n: Column) -> Column:
    """0 .. n-1; empty for n < 1."""
    return F.when(n < 1, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship() -> None:
    """Pickle this subpackage's functions by value, so Python workers need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules["churnlane.llm"])


def per_batch(df: DataFrame, keep: list[str], fields: str, types: dict[str, pa.DataType], make: Callable) -> DataFrame:
    """The columns ``keep`` of ``df`` and new ones that Python computes from Arrow batches.

    ``make()`` runs once a task and returns a function from a batch to the new
    columns by name; ``fields`` is their DDL, ``types`` their Arrow types.  Kept
    columns stay Arrow columns, so ids of any type, nulls among them, come back
    unchanged (as pandas columns, long ids beside a null would turn into doubles).
    """
    ship()

    def run(batches):
        judge = make()
        for b in batches:
            new = judge(b)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *(pa.array(new[n], t) for n, t in types.items())], names=[*keep, *types])
    return df.mapInArrow(run, StructType([*(df.schema[c] for c in keep), *StructType.fromDDL(fields).fields]))
