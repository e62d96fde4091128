"""Physical layout jobs: clustered writes, compaction, partitioning, Z-order (LAY-1..4).

Parquet stores ``CLUSTER BY`` only as table metadata, so a clustered write
must *produce* clustered files: range-partition on the clustering columns and
sort within each partition, so each file covers a tight key range and
Parquet min/max statistics let scans skip files and row groups.

``OPTIMIZE`` becomes a rewrite job: read, lay out again with a file count
derived from the data size, write into a NEW directory, then repoint the
table (``ALTER TABLE SET LOCATION``).  The old files are never overwritten
in place, so a failure mid-job leaves the table readable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlane.session import pin, scratch_path, unique_name
from churnlane.sources.sinks import swap_in

TARGET_FILE_BYTES = 128 * 1024 * 1024


def row_hash(df: DataFrame) -> Column:
    """Deterministic per-row hash of all columns (a tie-breaker, stable on task retry)."""
    return F.xxhash64(*_hashable(df))


def _hashable(df: DataFrame) -> list[Column]:
    return [F.to_json(F.struct(F.col(f.name))) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in df.schema.fields]


def with_tie_breaks(df: DataFrame) -> DataFrame:
    """Add ``_rh`` (row hash) and ``_cp`` (copy number) so that the range key
    ``(..., _rh, _cp)`` is unique per row, even for exact copies.

    ``_cp`` is the row's position after sorting its input partition by two
    hashes of its content (96 bits).  Rows are then numbered in a
    content order; identical rows are interchangeable, so a retried map task
    routes the same multiset of rows to the same ranges and no row is lost or
    doubled, whatever order its input arrived in.
    """
    return (df.withColumn("_rh", row_hash(df)).withColumn("_rh2", F.hash(*_hashable(df)))
              .sortWithinPartitions("_rh", "_rh2").drop("_rh2")
              .withColumn("_cp", F.monotonically_increasing_id()))


def without_tie_breaks(df: DataFrame) -> DataFrame:
    return df.drop("_rh", "_cp")


def clustered(df: DataFrame, cols: Sequence[str], files: int) -> DataFrame:
    """Range-partition on ``cols`` into ``files`` partitions, sorted within each.

    The range key ends with tie-breaks that make it unique per row (row
    hash, copy number): if one ``cols`` tuple holds a third of all rows — even
    a third made of exact copies — its rows spread over several range
    partitions (adjacent files) instead of one task writing one giant file.
    Sorting is by ``cols`` first, so clustering is unchanged.
    """
    return (with_tie_breaks(df)
            .repartitionByRange(files, *cols, "_rh", "_cp").sortWithinPartitions(*cols, "_rh", "_cp")
            .drop("_rh", "_cp"))


def partitioned_write(df: DataFrame, path: str, col: str, files: int | None = None,
                      mode: str = "overwrite") -> None:
    """``partitionBy(col)`` with the write spread by row count, not by value.

    ``repartition(col)`` alone sends every row of a value to one task (a
    2-valued column is written by 2 tasks); a fixed salt only multiplies that
    by a constant.  Range-partitioning on ``(col, row hash, copy number)`` into ``files``
    ranges (default: the shuffle partition count, which ``cluster_conf``
    sizes from the input) lets Spark's sampled range bounds split a value
    holding most rows over many tasks while rare values share one; each task
    writes one file per value in its range.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    (with_tie_breaks(df)
       .repartitionByRange(n, F.col(col), F.col("_rh"), F.col("_cp")).drop("_rh", "_cp")
       .write.mode(mode).partitionBy(col).parquet(path))


def table_bytes(spark: SparkSession, name: str) -> int:
    """Size of a table's files from the catalog (``ANALYZE ... NOSCAN``: no data read)."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Statistics'").collect()
    if not rows:
        return 0
    return int(rows[0]["data_type"].split(" ")[0])


def files_for(nbytes: int, target: int = TARGET_FILE_BYTES) -> int:
    return max(1, -(-nbytes // target))


def clustering_of(spark: SparkSession, name: str) -> list[str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    out, on = [], False
    for r in rows:
        if r["col_name"] == "# Clustering Information":
            on = True
            continue
        if on:
            if not r["col_name"] or r["col_name"].startswith("#"):
                if out:
                    break
                continue
            out.append(r["col_name"])
    return out


def table_layout(spark: SparkSession, name: str) -> tuple[int, list[str], list[str], list[str]]:
    """Bucket count, bucket columns, sort columns and partition columns of a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    said = {r["col_name"]: r["data_type"] for r in rows}
    names = lambda k: [c.strip(" `") for c in said.get(k, "").strip("[]").split(",") if c.strip(" `")]
    parts, on = [], False
    for r in rows:
        if r["col_name"].startswith("# Partition Information"):
            on = True
        elif on and (not r["col_name"] or r["col_name"].startswith("# Detailed")):
            break
        elif on and not r["col_name"].startswith("#"):
            parts.append(r["col_name"])
    return int(said.get("Num Buckets", 0) or 0), names("Bucket Columns"), names("Sort Columns"), parts


def _quoted(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def write_clustered(spark: SparkSession, df: DataFrame, name: str, cols: Sequence[str],
                    files: int, mode: str = "append") -> None:
    """Append/overwrite with clustering metadata repeated (G14) and clustered files (LAY-1)."""
    clustered(df, cols, files).write.mode(mode).clusterBy(*cols).saveAsTable(name)


def compact(spark: SparkSession, name: str, cols: Sequence[str] | None = None,
            target_bytes: int = TARGET_FILE_BYTES) -> str:
    """Rewrite a table into ``bytes / target`` clustered files (LAY-3).

    A plain table's location is swapped.  A bucketed or partitioned table is
    written anew with the same buckets or partitions and swapped in whole,
    since its catalog entry describes its files.
    """
    cols = list(cols or clustering_of(spark, name))
    buckets, by, sort, parts = table_layout(spark, name)
    if buckets or parts:
        n = files_for(table_bytes(spark, name), target_bytes)
        new_path, staging = scratch_path(spark, f"compact-{name}"), unique_name("compact_staging")
        src = spark.read.table(name)
        if buckets:
            w = src.repartition(buckets, *by).write.format("parquet").option("path", new_path).bucketBy(buckets, *by)
            w = w.sortBy(*sort) if sort else w
        else:
            spread = with_tie_breaks(src).repartitionByRange(n, *parts, "_rh", "_cp").drop("_rh", "_cp")
            w = spread.write.format("parquet").option("path", new_path)
        w = w.partitionBy(*parts) if parts else w
        w.saveAsTable(staging)
        props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        kept = ", ".join(f"'{k}' = '{_quoted(v)}'" for k, v in props.items() if k in ("primary_keys", "kind", "comment"))
        if kept:
            spark.sql(f"ALTER TABLE {staging} SET TBLPROPERTIES ({kept})")
        swap_in(spark, staging, name)
        return new_path
    n = files_for(table_bytes(spark, name), target_bytes)
    src = spark.read.table(name)
    new_path = scratch_path(spark, f"compact-{name}")
    out = clustered(src, cols, n) if cols else src.repartition(n)
    out.write.mode("overwrite").parquet(new_path)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new_path}'")
    spark.catalog.refreshTable(name)
    return new_path


def file_ranges(df: DataFrame, col: str) -> DataFrame:
    """Per data file: rows and min/max of ``col`` (how well files are clustered)."""
    return (df.select(F.input_file_name().alias("file"), col)
              .groupBy("file").agg(F.count(F.lit(1)).alias("rows"),
                                   F.min(col).alias("min_value"), F.max(col).alias("max_value")))


def interleave_bits(cols: Sequence[Column], bits: int = 8) -> Column:
    """Z-value: bit-interleave small non-negative integers (bit i of column j -> i*k + j)."""
    k = len(cols)
    z = F.lit(0).cast("bigint")
    for i in range(bits):
        for j, c in enumerate(cols):
            bit = F.shiftright(c.cast("bigint"), i).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, i * k + j))
    return z


def zorder(df: DataFrame, cols: Sequence[str], files: int, bits: int = 8) -> DataFrame:
    """Z-order layout (LAY-4): rank each column into ``2^bits`` quantile buckets
    (one approximate-quantile pass over all of them, JVM side), interleave the bucket
    bits, range-partition and sort on the Z-value.  The input is pinned: it is read
    for the quantiles, the range sample and the write."""
    df = pin(df)
    names = [f"_zr_{c}" for c in cols]
    qd = QuantileDiscretizer(numBuckets=2 ** bits, inputCols=list(cols), outputCols=names, handleInvalid="keep", relativeError=0.001)
    out = qd.fit(df).transform(df)
    z = interleave_bits([F.col(n) for n in names], bits)
    keyed = with_tie_breaks(out.withColumn("_z", z).drop(*[f"_zr_{c}" for c in cols]))
    return (keyed.repartitionByRange(files, "_z", "_rh", "_cp").sortWithinPartitions("_z", "_rh", "_cp")
                 .drop("_z", "_rh", "_cp"))
