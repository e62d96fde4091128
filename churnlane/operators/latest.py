"""Newest row per key (AGG-1 re-aimed on data, WIN-1, SNK-6).

Expressed as an *aggregation*, not a window: ``max_by(row, (ts, tie))`` per
key.  The aggregate runs partially on the map side, so a key that holds a
third of all rows is reduced inside every task before the shuffle; a
``row_number() OVER (PARTITION BY key ...)`` would instead sort all of that
key's rows in one task.  Ties on ``ts`` are broken by ``tie`` (descending, the
same order as the window form), so the result is deterministic and
idempotent: merging a snapshot with any subset of rows it already contains
returns the same snapshot.

The price: rows are no fixed-width buffers, so Spark aggregates by sorting,
first each task's own rows, then what is left of them after the shuffle (a row
a key and task).  Finding the winning (ts, tie) by hash and fetching the rows
by a join instead would shuffle and sort the whole table for that join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.session import default_buckets


def latest_per_key(df: DataFrame, keys: Sequence[str] | str, ts: str,
                   tie: Sequence[str] | str = ()) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    tie = [tie] if isinstance(tie, str) else list(tie)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in [ts, *tie]])
    row = F.struct(*[F.col(c) for c in rest])
    # NULL timestamps sort below all others: such a row wins only where a key has no other
    agg = df.groupBy(*keys).agg(F.max_by(row, order).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def publish_snapshot(df: DataFrame, path: str, key: Sequence[str] | str, buckets: int | None = None,
                     table: str | None = None, bloom: bool = True) -> None:
    """Write a key-unique snapshot as a full copy into a NEW path (SNK-6).

    ``bloom``: row groups carry a Bloom filter of each key column, so a lookup whose keys
    reach the scan (``point_lookup``) skips those that cannot hold any; the
    files are parts of the key's hash, whose minimum and maximum tell nothing.

    With ``table``: a Parquet table sorted by the key.  With ``buckets`` it is
    bucketed too: joins on the key then move only the request side, but AQE
    splits a hot key only where *both* sides are shuffled, so with buckets
    pass ``skew_fraction`` to the lookups (or know that requests are even).
    ``repartition(n, key)`` first uses the same hash as the buckets, so each
    task writes exactly one bucket file.
    """
    keys = [key] if isinstance(key, str) else list(key)
    n = buckets or default_buckets(df.sparkSession)
    out = df.repartition(n, *keys)
    options = {f"parquet.bloom.filter.enabled#{k}": "true" for k in keys} if bloom else {}
    if table and not buckets:
        (out.sortWithinPartitions(*keys).write.options(**options).mode("overwrite").format("parquet").option("path", path)
            .saveAsTable(table))
    elif table:
        (out.write.options(**options).mode("overwrite").format("parquet").option("path", path)
            .bucketBy(n, *keys).sortBy(*keys).saveAsTable(table))
    else:
        out.sortWithinPartitions(*keys).write.options(**options).mode("overwrite").parquet(path)
