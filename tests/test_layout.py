"""Layout jobs (LAY-1..4): rows unchanged, files really clustered, hot values spread."""

import contextlib
import io
import os

from pyspark.sql import functions as F

from churnlane.operators.layout import (clustered, compact, file_ranges, files_for, partitioned_write,
                                        table_bytes, zorder)
from churnlane.session import scratch_path
from churnlane.sources.sinks import write_table


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _hot_frame(spark):
    # (a=0, b=0) holds half of all rows; the rest spread over a, b
    hot = [(0, 0, i) for i in range(3000)]
    rest = [(1 + i % 50, i % 7, 10000 + i) for i in range(3000)]
    return spark.createDataFrame(hot + rest, "a int, b int, v int").repartition(5)


def test_clustered_spreads_a_hot_tuple_and_keeps_ranges(spark):
    df = _hot_frame(spark)
    out = clustered(df, ["a", "b"], 6)
    assert _rows(out) == _rows(df)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p"))
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 0.4 * df.count()            # the hot half is split over several files
    # files are ordered by (a, b): each file's max <= the next file's min
    spans = sorted((r["lo"], r["hi"]) for r in out.groupBy(F.spark_partition_id().alias("p"))
                   .agg(F.min(F.struct("a", "b")).alias("lo"), F.max(F.struct("a", "b")).alias("hi"))
                   .collect())
    assert all(tuple(x[1]) <= tuple(y[0]) for x, y in zip(spans, spans[1:]))


def test_partitioned_write_spreads_low_cardinality_values(spark):
    df = _hot_frame(spark).withColumn("flag", (F.col("a") == 0).cast("int"))
    path = scratch_path(spark, "by-flag")
    partitioned_write(df, path, "flag", files=8)
    back = spark.read.parquet(path)
    assert _rows(back.select("a", "b", "v", "flag")) == _rows(df.select("a", "b", "v", "flag"))
    for v in (0, 1):
        files = [f for f in os.listdir(os.path.join(path.replace("file:", ""), f"flag={v}"))
                 if f.endswith(".parquet")]
        assert len(files) > 1                       # several tasks wrote each value
    one = back.where("flag = 1")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        one.explain()
    assert "PartitionFilters: [isnotnull(flag" in buf.getvalue()   # pruned, not filtered
    assert one.count() == 3000


def test_compact_rewrites_to_size_based_file_count(spark):
    df = _hot_frame(spark)
    name = write_table(spark, df.repartition(24), "frag")
    spark.sql(f"ALTER TABLE {name} CLUSTER BY (a, b)")
    want_files = files_for(table_bytes(spark, name), 64 * 1024)
    compact(spark, name, target_bytes=64 * 1024)
    back = spark.read.table(name)
    assert _rows(back) == _rows(df)
    nfiles = back.select(F.input_file_name()).distinct().count()
    assert nfiles <= want_files
    ranges = sorted((r["min_value"], r["max_value"]) for r in file_ranges(back, "a").collect())
    assert all(x[1] <= y[0] for x, y in zip(ranges, ranges[1:]))


def test_zorder_keeps_rows(spark):
    df = _hot_frame(spark)
    out = zorder(df, ["a", "b"], 4)
    assert _rows(out) == _rows(df)
    assert out.columns == df.columns


def test_clustered_spreads_exact_copies(spark):
    """Half the rows are ONE row repeated: the copies still span several files."""
    copies = [(0, 0, 0)] * 3000 + [(1 + i % 50, i % 7, i) for i in range(3000)]
    df = spark.createDataFrame(copies, "a int, b int, v int").repartition(5)
    for out in (clustered(df, ["a", "b"], 6), zorder(df, ["a", "b"], 6)):
        assert _rows(out) == _rows(df)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count(F.lit(1)).alias("n")).collect()]
        assert max(sizes) < 0.4 * df.count()


def test_compact_keeps_buckets_and_partitions(spark):
    from churnlane.operators.features import FeatureLookup, create_feature_table, lookup
    from churnlane.operators.layout import compact, table_layout
    from churnlane.session import scratch_path, unique_name
    df = spark.range(0, 1000, 1, 8).selectExpr("id AS k", "id * 2 AS v", "id % 3 AS p", "map('a', id) AS m")
    b, p = unique_name("compact_bucketed"), unique_name("compact_partitioned")
    create_feature_table(spark, b, df.drop("m"), ["k"], buckets=4)
    df.write.partitionBy("p").option("path", scratch_path(spark, "parts")).saveAsTable(p)
    before = {t: spark.read.table(t).count() for t in (b, p)}
    files = len(spark.read.table(p).inputFiles())
    for t in (b, p):
        compact(spark, t)
        assert spark.read.table(t).count() == before[t] and spark.read.table(t).agg({"v": "sum"}).first()[0] == 999000
    assert table_layout(spark, b)[:3] == (4, ["k"], ["k"]) and table_layout(spark, p)[3] == ["p"]
    assert len(spark.read.table(b).inputFiles()) == 4 and len(spark.read.table(p).inputFiles()) < files
    joined = lookup(spark, spark.range(1000).withColumnRenamed("id", "k"),
                    [FeatureLookup.of(b, "k")])
    assert joined.where("v is null").count() == 0
