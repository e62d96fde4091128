"""Running sums along an order, without one task holding a whole order.

``sum() OVER (PARTITION BY g ORDER BY x)`` moves a group into one task; where a
group may hold a third of the rows (or there is no group), that task does not
end.  Here the rows are range-partitioned on (group, order), those ranges are
written down, running sums are taken inside a range, and the totals of the ranges
before it are added: at most one row for each group and range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlane.session import default_buckets, staged

_RANGE = "_range"


def running_sums(df: DataFrame, by: Sequence[str], order: str, sums: Sequence[str], ranges: int | None = None,
                 following: str | None = None) -> DataFrame:
    """``df`` with, for each column of ``sums``, ``run_<c>`` (its sum up to and with this row) and ``all_<c>`` (over the group).

    ``df`` has one row per (``by``, ``order``), ``by`` without NULLs.  ``following``: also the next
    larger ``order`` value of the group, under this name (NULL at its end).
    """
    n = ranges or default_buckets(df.sparkSession)
    by = list(by)
    # sampled cut points differ between runs: what is written fixes which range a row is in, for both uses
    rows, _ = staged(df.repartitionByRange(n, *by, order).withColumn(_RANGE, F.spark_partition_id()), "running")
    totals = rows.groupBy(*by, _RANGE).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums], F.min(order).alias("_first"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, _RANGE,
                            *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
                            *[F.sum(f"_t_{c}").over(group).alias(f"all_{c}") for c in sums],
                            F.lead("_first").over(group.orderBy(_RANGE)).alias("_next"))
    inside = Window.partitionBy(*by, _RANGE).orderBy(order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = rows
    for c in sums:
        out = out.withColumn(f"_r_{c}", F.sum(c).over(upto))
    if following:
        out = out.withColumn("_lead", F.lead(order).over(inside))
    keys = [*by, _RANGE]
    joined = out.join(offsets, keys)
    cols = [*df.columns, *[(F.col(f"_r_{c}") + F.col(f"_o_{c}")).alias(f"run_{c}") for c in sums], *[f"all_{c}" for c in sums]]
    if following:
        cols.append(F.coalesce("_lead", "_next").alias(following))
    return joined.select(*cols)
