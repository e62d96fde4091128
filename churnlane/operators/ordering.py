"""Global row positions without a one-partition window (WIN-2, PRJ-7).

``row_number() OVER (ORDER BY k)`` with no PARTITION BY moves every row into a
single task.  Instead (the DataFrame form of ``zipWithIndex`` over a sort):

1. the input is pinned (reliable checkpoint) and given a stable row id — its
   position in the pinned files — as the last tie-break, so the full sort key
   ``(key, *tie_break, row id)`` is unique;
2. ``repartitionByRange(n, sort key)`` + ``sortWithinPartitions``: Spark's
   range partitioner samples the *whole* sort key, so a key value holding a
   third of all rows — or a third of the rows being exact copies — is split
   over many adjacent ranges by the tie-breaks instead of landing in one task;
3. that layout is pinned, so the partition ids seen by the next two jobs are
   the same ranges (a re-sampled range partitioner could draw other bounds);
4. per-partition row counts (one row per partition, ``n`` at most, to the
   driver) become running offsets, inlined as one literal array;
5. position = offset of the partition + record number inside it, both read
   from ``monotonically_increasing_id()`` (partition id in the upper bits,
   record number in the lower 33) on the pinned, already-sorted partitions —
   a projection, no further shuffle or sort.

Every task sorts about ``N/n`` rows, whatever the key distribution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.functions.columns import array_literal
from churnlane.session import pin

_LOW_BITS = (1 << 33) - 1   # record number inside a partition in monotonically_increasing_id


def _buckets(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def row_position(df: DataFrame, key: str, out: str = "position",
                 tie_break: Sequence[str] = (), buckets: int | None = None,
                 start: int = 0, pin_input: bool = True) -> DataFrame:
    """0-based (or ``start``-based) position of each row in ``key`` order.

    ``key`` sorts ascending with NULLs last, then ``tie_break`` columns; rows
    equal in all of them are numbered in an arbitrary but fixed order.
    ``pin_input=False`` only for an input read straight from files (its row
    ids are then already stable across jobs and task retries).
    """
    n = buckets or _buckets(df)
    src = pin(df) if pin_input else df
    src = src.withColumn("_rid", F.monotonically_increasing_id())
    order = ([F.col(key).asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie_break]
             + [F.col("_rid").asc()])
    ranged = pin(src.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_rid"))
    # one row per non-empty partition: bounded by ``n``, not by the data
    counts = dict(ranged.groupBy(F.spark_partition_id().alias("_p"))
                        .agg(F.count(F.lit(1)).alias("_n")).collect())
    offsets, run = [], 0
    for p in range(max(counts, default=-1) + 1):
        offsets.append(run)
        run += counts.get(p, 0)
    if not offsets:                       # empty input: no row will look an offset up
        offsets = [0]
    # the id is evaluated once per row (its own projection); partition and
    # record number are both read from that one value
    mid = F.col("_mid")
    off = F.element_at(array_literal(offsets, "bigint"), (F.shiftright(mid, 33) + 1).cast("int"))
    pos = off + mid.bitwiseAND(F.lit(_LOW_BITS)) + F.lit(start)
    return (ranged.withColumn("_mid", F.monotonically_increasing_id())
                  .withColumn(out, pos.cast("bigint")).drop("_mid"))


def surrogate_key(df: DataFrame, out: str = "unique_id", order_by: str | None = None) -> DataFrame:
    """Add a surrogate row id (PRJ-7).

    ``order_by`` given: the stable variant — the 0-based position in that
    column's order (``row_position``), identical across runs and layouts.
    Otherwise ``monotonically_increasing_id()`` as the reference does: unique
    and cheap (no shuffle), but its values depend on the partitioning (G10),
    so the result is pinned with a reliable ``checkpoint()`` in the shared
    checkpoint dir before anyone joins on it — a recomputation after an
    executor loss would otherwise be free to hand out different ids.
    """
    if order_by is not None:
        return row_position(df, order_by, out)
    return pin(df.withColumn(out, F.monotonically_increasing_id()))
