"""Table sinks: typed tables, evolving appends, materialised datasets, statistics,
request capture (SNK-1, SNK-2, SNK-5, SNK-7, AGG-3 catalog variant).

Tables are Parquet data-source tables whose files live under the shared
scratch root (``spark.checkpoint.dir``), never a machine-local folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnlane.session import scratch_path, unique_name
from churnlane.sources import control


def _q(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def write_table(spark: SparkSession, df: DataFrame, prefix: str, mode: str = "overwrite",
                cluster_by: Sequence[str] | None = None, partition_by: Sequence[str] | None = None,
                name: str | None = None) -> str:
    """Write ``df`` as a new Parquet table below the shared root; returns its name."""
    name = name or unique_name(prefix)
    w = df.write.mode(mode).format("parquet").option("path", scratch_path(spark, f"tbl-{name}"))
    if cluster_by:
        w = w.clusterBy(*cluster_by)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return name


def create_typed_table(spark: SparkSession, name: str, ddl: str,
                       cluster_by: Sequence[str] | None = None, comment: str | None = None) -> str:
    """``CREATE OR REPLACE TABLE`` for Parquet: drop if present, then create (SNK-1, G12)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sql = f"CREATE TABLE {name} ({ddl}) USING parquet LOCATION '{scratch_path(spark, 'tbl-' + name)}'"
    if cluster_by:
        sql += f" CLUSTER BY ({', '.join(cluster_by)})"
    if comment:
        sql += f" COMMENT '{_q(comment)}'"
    spark.sql(sql)
    return name


def append_evolve(spark: SparkSession, df: DataFrame, name: str) -> None:
    """Append with schema evolution (SNK-2).

    New columns of ``df`` are added to the table first (``ALTER TABLE ADD
    COLUMNS``); then ``df`` is conformed to the table schema by name — missing
    nullable columns become NULL, types are cast — and inserted.
    """
    target = spark.table(name).schema
    have = {f.name.lower() for f in target.fields}
    new = [f for f in df.schema.fields if f.name.lower() not in have]
    if new:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
        target = spark.table(name).schema
    conformed = df.to(target)
    conformed.write.insertInto(name)


def swap_in(spark: SparkSession, staging: str, name: str, keep_old: bool = True) -> None:
    """Make the fully written table ``staging`` the table ``name``.

    The data job has finished before the old table is touched, so a failed
    or lost job leaves the previous table as it was.  Where the new table has the
    old one's columns and layout, the old entry is pointed at the new files by one
    catalog operation, so there is no moment without a table; else the entry is
    replaced by two (drop, rename).  No data moves.  ``keep_old=False`` removes the
    old files, which a running query may still be reading.
    """
    old = location_of(spark, name) if spark.catalog.tableExists(name) else None
    if old and _same_layout(spark, staging, name):
        new = location_of(spark, staging)
        properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {staging}").collect()}
        pairs = ", ".join(f"'{_q(k)}' = '{_q(v)}'" for k, v in properties.items() if not k.startswith(("transient_", "spark.sql.")))
        if pairs:
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{new}'")
        spark.sql(f"DROP TABLE {staging}")                     # an external table: its files stay
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
    if old and not keep_old:
        control.delete(spark, old)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def location_of(spark: SparkSession, name: str) -> str:
    return _described(spark, name)["Location"]


def _same_layout(spark: SparkSession, a: str, b: str) -> bool:
    """Both external Parquet tables of the same columns, neither partitioned, bucketed nor clustered."""
    x, y = _described(spark, a), _described(spark, b)
    plain = all(d.get("Type") == "EXTERNAL" and d.get("Provider", "").lower() == "parquet" and "Num Buckets" not in d
                and "# Partition Information" not in d and "# Clustering Information" not in d for d in (x, y))
    return plain and spark.table(a).schema == spark.table(b).schema


def materialize(spark: SparkSession, name: str, df: DataFrame, comment: str = "",
                properties: Mapping[str, str] | None = None,
                cluster_by: Sequence[str] | None = None) -> DataFrame:
    """A named dataset with comment and table properties, rewritten each run (SNK-5).

    Written as a staging table in a new directory first, then swapped in
    (``swap_in``): while the write runs, readers see the old dataset."""
    staging = unique_name(f"{name}_staging")
    write_table(spark, df, staging, cluster_by=cluster_by, name=staging)
    if comment:
        spark.sql(f"COMMENT ON TABLE {staging} IS '{_q(comment)}'")
    if properties:
        props = ", ".join(f"'{_q(k)}' = '{_q(v)}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {staging} SET TBLPROPERTIES ({props})")
    swap_in(spark, staging, name)
    return spark.read.table(name)


def analyze_table(spark: SparkSession, name: str) -> DataFrame:
    """``ANALYZE ... FOR ALL COLUMNS`` then the catalog statistics per column.

    The result is catalog metadata (``DESCRIBE EXTENDED t col`` rows), one
    small frame per column, unioned.
    """
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    out = None
    for c in spark.table(name).columns:
        d = spark.sql(f"DESCRIBE EXTENDED {name} `{c}`").withColumn("column", F.lit(c))
        out = d if out is None else out.unionByName(d)
    return out


def sent(requests: DataFrame, out: str = "request") -> DataFrame:
    """``requests`` with each row as it was sent, as JSON (absent fields as null): before any lookup or cast."""
    return requests.withColumn(out, F.to_json(F.struct(*requests.columns), {"ignoreNullFields": "false"}))


def capture_frame(predictions: DataFrame, outputs: Sequence[str], served_model: str, request: str = "request",
                  request_id: str | None = None, batch_id: int | None = None) -> DataFrame:
    """Request/response capture rows (SNK-7): JSON payloads + model + batch id.

    Columns: ``request_id`` (the client's, from column ``request_id``; else one of
    the row's own, so that repeated keys stay apart), ``served_model``,
    ``request`` (what ``sent`` kept of it), ``response`` (JSON of the outputs), ``batch_id``.
    """
    own = F.concat_ws("-", F.lit(batch_id).cast("string"), F.monotonically_increasing_id().cast("string"))
    return predictions.select(
        (F.col(request_id).cast("string") if request_id else own).alias("request_id"),
        F.lit(served_model).alias("served_model"), F.col(request).alias("request"),
        F.to_json(F.struct(*[F.col(o) for o in outputs])).alias("response"),
        F.lit(batch_id).cast("bigint").alias("batch_id"))


def parse_capture(log: DataFrame, request_schema: StructType, response_schema: StructType) -> DataFrame:
    """Capture rows with the JSON payloads parsed back into columns."""
    return log.select(
        "request_id", "served_model", "batch_id",
        F.from_json("request", request_schema).alias("q"),
        F.from_json("response", response_schema).alias("r")).select(
        "request_id", "served_model", "batch_id", "q.*", "r.*")


def use_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """``USE CATALOG c; USE SCHEMA s`` on the session catalog: create the database
    (its files below the shared root unless ``location`` is given) and make it current."""
    loc = location or scratch_path(spark, f"db-{schema}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{loc}'")
    spark.catalog.setCurrentDatabase(schema)
