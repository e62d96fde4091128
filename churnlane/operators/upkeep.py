"""Compaction of only the files that need it (LAY-3).

``layout.compact`` rewrites a whole table.  After an append, most files of a
clustered table are as they should be: of full size, and sharing their key range
with few others.  ``compact_files`` looks at every file's size and range of the
first clustering column (one aggregation over that column), chooses

* files below half the target size, and
* files of a stretch of keys that more than ``max_overlap`` files share,

rewrites these alone, clustered, and leaves all others untouched under their
names.  File facts are one row a file: they are the table's listing, not its rows.

New files are written outside the table first.  The exchange then is a list of
renames, written down before the first one is made (``_compaction`` beside the
files): a run that finds such a list finishes it before anything else, so a lost
driver leaves no half-made exchange.  Between the renames a reader may find
files missing, as with any plain Parquet folder; readers that cannot wait read a
table of ``layout.compact``, whose location changes at once.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlane.operators.layout import TARGET_FILE_BYTES, clustered, clustering_of, table_layout
from churnlane.session import scratch_path
from churnlane.sources import control
from churnlane.sources.sinks import location_of

JOURNAL = "_compaction"


@dataclass(frozen=True)
class FileFacts:
    path: str
    size: int
    rows: int
    low: object
    high: object


def file_facts(df: DataFrame, col: str) -> list[FileFacts]:
    """Size, rows and key range of each file of a plain Parquet frame (one row a file to the driver)."""
    rows = (df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"), F.col(col).alias("k"))
            .groupBy("p", "s").agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).collect())
    return [FileFacts(r.p, r.s, r.n, r.low, r.high) for r in rows]


def choose(files: Sequence[FileFacts], target: int, max_overlap: int = 2) -> list[list[FileFacts]]:
    """Groups of files to rewrite together: each a stretch of keys, in order.

    A sweep over the files by key finds those in crowded stretches.  Wanted files
    whose ranges meet are one group; small ones that do not are packed with the
    next small ones up to the target size.  A lone file is left as it is.
    """
    known = sorted((f for f in files if f.low is not None), key=lambda f: (f.low, f.high, f.path))
    crowded: set[str] = set()
    open_: list[FileFacts] = []
    for f in known:
        open_ = [o for o in open_ if o.high >= f.low] + [f]
        if len(open_) > max_overlap:
            crowded.update(o.path for o in open_)

    groups: list[list[FileFacts]] = [[]]
    reach, size = None, 0
    for f in known:
        small = f.size * 2 < target
        if not small and f.path not in crowded:
            continue
        meets = groups[-1] and f.low <= reach
        packs = groups[-1] and small and size + f.size <= target
        if not (meets or packs):
            groups.append([])
            reach, size = None, 0
        groups[-1].append(f)
        reach = f.high if reach is None else max(reach, f.high)
        size += f.size
    keyless = [f for f in files if f.low is None and f.size * 2 < target]
    return [g for g in [*groups, keyless] if len(g) > 1]


def finish(spark: SparkSession, folder: str) -> bool:
    """Completes an exchange that was written down but not finished; whether there was one."""
    text = control.read_text(spark, f"{folder}/{JOURNAL}")
    if not text:
        return False
    todo = json.loads(text)
    for path in todo["old"]:
        control.delete(spark, path)
    for source, to in todo["new"]:
        control.rename(spark, source, to)                    # one already made has no source any more
    control.delete(spark, f"{folder}/{JOURNAL}")
    return True


def compact_files(spark: SparkSession, name: str, cols: Sequence[str] | None = None, target_bytes: int = TARGET_FILE_BYTES,
                  max_overlap: int = 2) -> dict[str, int]:
    """Rewrites the files of table ``name`` that need it; how many were rewritten, written and left."""
    cols = list(cols or clustering_of(spark, name))
    buckets, _, _, parts = table_layout(spark, name)
    if buckets or parts or not cols:
        raise ValueError("compact_files is for plain tables with clustering columns; compact rewrites the others")
    folder = location_of(spark, name)
    if finish(spark, folder):
        spark.catalog.refreshTable(name)
    files = file_facts(spark.read.table(name), cols[0])
    groups = choose(files, target_bytes, max_overlap)
    schema = spark.read.table(name).schema
    moves: list[tuple[str, str]] = []
    for group in groups:                                     # as many as there are crowded stretches
        staging = scratch_path(spark, "compact-files")
        rows = spark.read.schema(schema).parquet(*[f.path for f in group])
        n = max(1, -(-sum(f.size for f in group) // target_bytes))
        clustered(rows, cols, n).write.parquet(staging)
        for k, path in enumerate(sorted(control.list_files(spark, staging, ".parquet"))):
            moves.append((path, f"{folder}/{staging.rsplit('/', 1)[1]}-{k:05d}.parquet"))
    if groups:
        old = [f.path for g in groups for f in g]
        control.write_text(spark, f"{folder}/{JOURNAL}", json.dumps({"old": old, "new": moves}))
        finish(spark, folder)
        spark.catalog.refreshTable(name)
    rewritten = sum(len(g) for g in groups)
    return {"rewritten": rewritten, "written": len(moves), "left": len(files) - rewritten}
