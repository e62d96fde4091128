"""Connected components of an edge table by alternating star contractions.

Each round reads and writes the edge table once per star step; a hub is
reduced by a partial ``min`` and its rows are joined against a pinned
one-row-per-node table, so AQE can broadcast that table or split the hub's
partition.  Nothing is collected but two totals a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.llm.common import discard, recorded, stage


def _totals(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (long ``a``, ``b``); the root is its component's smallest node."""
    with recorded() as older:
        e = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    before = None
    while (now := _totals(e)) != before:
        before = now
        with recorded() as written:
            # large star: every larger neighbour of a node moves to the node's smallest neighbour (or itself)
            both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = stage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "cc-min")
            e = stage(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .filter("a <> b").distinct(), "cc")
            # small star: every smaller neighbour of a node, and the node, move to the smallest of them
            least = stage(e.groupBy("a").agg(F.min("b").alias("m")), "cc-min")
            e = stage(e.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "cc")
        discard(edges.sparkSession, older)                       # of the round before; nothing reads it now
        older = written
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
